"""Archives read back, and the order of the merged index."""

import base64
import hashlib
import random

import pytest

from tickertide.llm import warc
from tickertide.llm.warc import LoserTree, archive_pages, archive_round_trip, read_history, sort_key


@pytest.mark.parametrize("sizes", [[], [0], [5], [3, 0, 4], [1] * 7, [50, 1, 20, 0, 33, 8, 8, 8, 100]])
def test_loser_tree(sizes):
    r = random.Random(4)
    runs = [sorted(r.randrange(30) for _ in range(n)) for n in sizes]
    assert list(LoserTree([iter(x) for x in runs])) == sorted(x for run in runs for x in run)


ROWS = (
    [(i, f"http://www.Site{i % 7}.example/{i % 11}?q={i}", f"<p>page {i % 40} é</p>" + "x" * (i % 300)) for i in range(300)]
    + [(1000 + i, "http://hot.example/", "hot") for i in range(200)]
    + [(2000, None, None), (2001, "http://e.example/ \r\nWARC-Type: odd", ""), (2002, "x", "long " * 100000), (None, "n", "hot"), (None, "n", "alone without id"), (None, "n", "alone without id"),
       (1199, "http://hot.example/", "hot"), (-5, "http://é.example/", "\r\n\r\n")]
)
SCHEMA = "page_id bigint, url string, html string"


def plain_records(rows):
    top = {}
    for i, _, h in rows:
        h = h or ""
        top[h] = max((x for x in (top.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        data, t = (h or "").encode(), top[h or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == t else "revisit", None if i == t else t))
    return sorted(out, key=str)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_round_trip(spark, monkeypatch, fan_in):
    monkeypatch.setattr(warc, "FAN_IN", fan_in)
    monkeypatch.setattr(warc, "BLOCK", 16)
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("key", pages_key()).repartition(7)
    rows = archive_round_trip(pages).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == plain_records(ROWS)
    url = {(i, h and hashlib.sha1(h.encode()).hexdigest()): u for i, u, h in ROWS}
    of = {i: u for i, u, _ in ROWS}
    ordered = [sort_key(r.page_id, of[r.page_id] or "") for r in sorted(rows, key=lambda r: (r.history, r.place)) if r.page_id is not None]
    assert ordered == sorted(ordered) and url
    assert len({(r.history, r.place) for r in rows}) == len(rows)


def pages_key():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_least_bytes_and_empty(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "a", "xy"), (3, "a", "longer"), (4, "a", "longer")], SCHEMA)
    got = {r.page_id: (r.record_type, r.refers_to) for r in archive_round_trip(pages, least_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    assert archive_round_trip(pages.limit(0)).count() == 0


def test_damage_is_found(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", "abc" * 100)], SCHEMA).repartition(1)
    folder, index, ranges = archive_pages(pages)
    from tickertide.llm.shared import place

    store, path = place(f"{folder}/archives/0.warc.gz")
    import zlib

    data = zlib.decompress(open(path, "rb").read(), 31).replace(b"abcabc", b"abcabd", 1)
    open(path, "wb").write(warc.gzip_member(data))
    with pytest.raises(Exception, match="damaged|zlib|Error"):
        read_history(spark, folder, index, ranges).collect()
