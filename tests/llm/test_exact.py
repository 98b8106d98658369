"""Exact duplicates against a dictionary of texts, with keys that collide."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tickertide.llm.exact import ExtendibleIndex, drop_duplicates, duplicate_groups

ROWS = (
    [(i, f"text {i % 40}", "s", "r") for i in range(120)]
    + [(200 + i, "hot " * 50, "s", None) for i in range(150)]
    + [(400, None, "n", "x"), (401, "", "e", "x"), (402, "long " * 40000, "l", "y"), (403, "long " * 40000, "l", "y"), (404, "long " * 39999 + "lone ", "l", "y")]
    + [(7, "text 7", "again", "z"), (None, "text 3", "q", "q"), (None, "no id", "q", "q"), (None, "no id", "q", "q"), (500, "Text 1", "c", None), (501, "é", "u", "u"), (502, "é", "u", "u")]
)
SCHEMA = "doc_id bigint, text string, key string, row string"


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("key_of", [F.xxhash64, lambda t: F.length(t) % 3 - 1, lambda t: F.lit(-5)])
def test_groups(spark, key_of):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(6)
    got = duplicate_groups(rows, key_of, capacity=4).select("id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_groups(ROWS), key=str)


def test_drop(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    left = drop_duplicates(rows)
    assert left.columns == rows.columns
    want = {(t or "") for _, t, *_ in ROWS}
    got = left.collect()
    assert len(got) == len(want) and {(r.text or "") for r in got} == want
    keep = {t: k for (_, k, *_), (_, t, *_) in zip(plain_groups(ROWS), ROWS)}
    assert all(r.doc_id == keep[r.text] for r in got if r.text is not None)


def test_empty(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert duplicate_groups(rows).count() == 0 and drop_duplicates(rows).count() == 0


def test_index_splits_and_doubles():
    index = ExtendibleIndex(2, capacity=3)
    keys = [(i * 0x9E3779B97F4A7C15) % 2**62 for i in range(500)] + [77] * 10
    for i, k in enumerate(keys):
        index.insert((k, "00" * 32, i, 1, 1))
    assert index.depth >= 6 and len(index.directory) == 2**index.depth
    for i, k in enumerate(keys):
        assert any(e[2] == i for e in index.buckets[index.directory[index.slot(k)]])
    for bucket in index.buckets:
        assert len(bucket) <= 3 or len({e[0] for e in bucket}) < len(bucket)
