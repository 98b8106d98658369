"""Targets, quotas and what is taken, against plain statements."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickertide.llm.mixing import mix, source_targets, split_quotas, taken_words, word_count


def plain_targets(sizes: dict, share=1.5, most=2):
    """Share by weight; what is above a cap is shared again until nothing is."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, shard string, size int")


def some_rows(n=600):
    names = ["a", "B", "é", None, "z", "hot"]
    return [
        (i, "hot" if i % 3 == 0 else names[i % 6], " ".join(["w"] * ((i * 7919) % 50)) + " \x85 ", "x", i) for i in range(n)
    ] + [(n, "a", None, None, None), (n + 1, "a", "", "y", 1), (5, names[5], "w w w", "again", 2), (None, "B", "w\x0bw", None, 3)]


def test_word_count(spark):
    texts = ["", " a  b\tc\x0bd\x0ce\r\n", "a\xa0b\x85c", None, "\n"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 5, 1, 0, 0]


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 1000, None: 50}, {"x": 10}, {"a": 0, "b": 0}, {"s%d" % i: (i * 37) % 91 for i in range(20)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want)


def test_taken(spark):
    docs = documents(spark, some_rows()).repartition(5)
    rows = taken_words(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = Counter(), Counter(), {}
    by_id = {(r.doc_id): r for r in rows}
    source = {i: s for i, s, *_ in some_rows()}
    longest = max(r.size for r in rows)
    for r in rows:
        assert r.taken % r.size == 0 if r.size else r.taken == 0
        assert r.taken <= 2 * r.size
        target[r.target] = r
    for r in rows:
        if r.doc_id != 5:
            sizes[source[r.doc_id]] += r.size
            taken[source[r.doc_id]] += r.taken
            assert r.source_size >= r.size
    for r in by_id.values():
        if r.doc_id not in (5, None) and source[r.doc_id] not in (None, "hot", "é"):
            assert abs(taken[source[r.doc_id]] - r.target) <= longest
    assert sorted(map(tuple, taken_words(docs.repartition(2)).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_more_passes(spark):
    """Four times every source: each document four times, as many passes as the caller allows."""
    docs = documents(spark, [(i, s, "w " * (i % 7 + 1), "s", 1) for i, s in enumerate(["a", "b", None] * 40)])
    assert all(r.taken == 4 * r.size for r in taken_words(docs, share=4.0, most=4).collect())


def test_mix_rows_are_the_taken_words(spark):
    docs = documents(spark, some_rows(300))
    taken = Counter()
    for r in taken_words(docs).collect():
        taken[r.doc_id] += r.taken
    mixed = mix(docs, shards=8).collect()
    assert set(docs.columns) <= set(mixed[0].asDict())
    count = Counter()
    for r in mixed:
        count[r.doc_id] += len([w for w in (r.text or "").replace("\x0b", " ").split(" ") if w])
    assert {k: v for k, v in count.items() if v} == {k: v for k, v in taken.items() if v}


def test_quotas_are_exact(spark):
    quotas = {0: 1000, 1: 1, 2: 300, 3: 0, 4: 37}
    rows = spark.createDataFrame(list(quotas.items()), "place int, quota bigint")
    total, sizes = defaultdict(int), defaultdict(int)
    for r in split_quotas(rows, 16, "s").collect():
        assert r.quota >= 0
        total[r.place] += r.quota
        sizes[r.shard] += r.quota
    assert dict(total) == quotas
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16


def test_draws_are_hypergeometric(spark):
    """Mean and variance of the left half over many seeds."""
    rows = spark.createDataFrame([(0, 60), (1, 140)], "place int, quota bigint")
    left = [
        r.quota for seed in range(60) for r in split_quotas(rows, 2, f"seed{seed}").where("place = 0 and shard = 0").collect()
    ]
    mean = sum(left) / len(left)
    assert abs(mean - 30) < 1.5  # standard error 0.42
    variance = sum((x - mean) ** 2 for x in left) / (len(left) - 1)
    assert 5 < variance < 20  # 100/199 * 60*140/200 * ... = 10.6


def test_empty(spark):
    assert taken_words(documents(spark, [])).count() == 0
    assert mix(documents(spark, [])).count() == 0
