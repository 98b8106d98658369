"""Repeated passages against a dictionary of windows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tickertide.llm import repeats
from tickertide.llm.repeats import first_places, remove_repeats

SPACE = "[^ \t\n\x0b\x0c\r]+"


def plain_repeats(rows, window):
    """(id, words, words removed, kept text) of each row."""
    key = lambda d, i: (d is not None, d or 0, i)
    first = {}
    texts = [(d, re.findall(SPACE, t or "")) for d, t, *_ in rows]
    for d, w in texts:
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            first[s] = min(first.get(s, key(d, i)), key(d, i))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(d, i):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def some_rows(seed, window):
    pick = random.Random(seed)
    word = lambda: pick.choice(["an", "the", "of", "é", "x y", "Word", "word", "日本"]) + str(pick.randrange(60))
    passages = [[word() for _ in range(pick.randrange(window, 4 * window))] for _ in range(6)]
    hot = [word() for _ in range(2 * window)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(pick.randrange(6)):
            words += [word() for _ in range(pick.randrange(2 * window))]
            words += pick.choice([pick.choice(passages), hot, [], ["same"] * pick.randrange(3 * window)])
        rows.append((pick.choice([i, -i]), pick.choice([" ", "\n", "\t \r\n"]).join(words), "s", i))
    rows += [rows[3], rows[4], (3, rows[5][1], "s", 0), (None, rows[6][1], None, 1), (None, " ".join(hot), "n", 2), (7000, None, None, 3), (7001, "", "", 4), (7002, " \n", "", 5)]
    rows.append((7003, " ".join(hot[: window - 1]), "short", 6))
    rows.append((7004, " ".join(word() for _ in range(30000)) + " " + " ".join(hot), "long", 7))
    return rows


@pytest.mark.parametrize("window, seed, crowd", [(5, 2, 8), (5, 5, 10**6), (20, 6, 4096), (20, 6, 0)])
def test_against_windows(spark, window, seed, crowd):
    rows = some_rows(window + crowd, window)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, row string, doc int").repartition(5)
    got = remove_repeats(frame, window, seed, crowd)
    found = [(r.id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()]
    assert sorted(found, key=str) == sorted(plain_repeats(rows, window), key=str)
    assert got.select("row.*").columns == frame.columns


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_small_chunks_keep_buckets_whole(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1)
    table = pa.table({
        "bucket": pa.array([1, 1, 2, 2, 2], pa.int64()),
        "packed": pa.array([b"a b c", b"z a b c", b"q r s", b"q r s", b"q r s t"], pa.binary()),
        "doc": pa.array([5, 2, 9, 9, None], pa.int64()), "start": pa.array([0, 4, 3, 1, 8], pa.int32()),
    })
    batches = [table.slice(i, 1).combine_chunks().to_batches()[0] for i in range(5)]
    found = [r for b in repeats.compare_buckets(3)(iter(batches)) for r in b.to_pylist()]
    assert [(r["doc"], r["known"], r["start"], r["firsts"]) for r in found] == [(5, 1, 0, 0), (9, 1, 1, 0)]


def test_hashes_that_collide():
    words = [f"w{i % 7}" for i in range(60)]
    strings = [" ".join(words[i : i + 8]).encode() for i in range(40)] + [b"a b c d e f g h", b"h g f e d c b a"]
    table = pa.table({
        "packed": pa.array(strings, pa.binary()), "doc": pa.array(range(len(strings)), pa.int64()),
        "start": pa.array([0] * len(strings), pa.int32()),
    })
    plain = first_places(table, 5)
    collided = first_places(table, 5, lambda ids, n: np.zeros(len(ids) - n + 1, np.uint64))
    assert plain.equals(collided) and plain.num_rows
