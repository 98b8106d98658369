"""Near copies against all pairs; signatures against exact similarity."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickertide.llm.components import components
from tickertide.llm.nearcopies import REGISTERS, drop_near_copies, near_copies, signatures, similarity, weighted_shingles
from tickertide.llm.words import U64


def shingles(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = low.split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def plain_similarity(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in a.keys() | b.keys())
    return total


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
    rows, i = [], 0
    common = [word() for _ in range(60)]
    for _ in range(25):
        base = [word() for _ in range(r.randint(30, 200))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                copy[r.randrange(len(copy))] = word()
            rows.append((i, " ".join(copy)))
            i += 1
    for _ in range(20):  # one passage in many texts that are otherwise different
        rows.append((i, " ".join([word() for _ in range(40)] + common + [word() for _ in range(40)])))
        i += 1
    twice = " ".join(word() for _ in range(50))
    rows += [(i, twice), (i + 1, twice + " " + twice), (i + 2, "one two"), (i + 3, "One  two"), (i + 4, "one"), (i + 5, ""), (i + 6, None)]
    rows += [(i + 7, ""), (None, twice), (i + 8, "the " * 3000), (i + 9, "the " * 5000), (3, rows[3][1])]
    return rows


def plain_classes(rows, least=0.8):
    rows = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(k, s) for k, s in rows if k is not None and s]
    for n, (k, s) in enumerate(known):
        for m, u in known[:n]:
            if plain_similarity(s, u) >= least:
                a, b = top(k), top(m)
                parent[max(a, b)] = min(a, b)
    return sorted(((k, None if k is None else top(k)) for k, _ in rows), key=str)


def test_classes(spark):
    rows = corpus()
    table = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, rep string, label int").repartition(5)
    got = near_copies(table)
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)
    kept = drop_near_copies(table)
    assert kept.columns == table.columns
    dropped = {k for k, c in plain_classes(rows) if k != c}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, _ in rows if k not in dropped)


def test_empty(spark):
    assert near_copies(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_similarity(seed):
    r = random.Random(seed)
    a = sorted(r.choices(range(1, 30), k=60))
    b = sorted(r.choices(range(10, 40), k=45))
    want = plain_similarity(Counter(a), Counter(b))
    assert similarity(np.array(a, U64), np.array(b, U64)) == pytest.approx(want)
    assert similarity(np.array(a, U64), np.array(sorted(a * 3), U64)) == pytest.approx(1.0)
    assert similarity(np.array(a, U64), np.zeros(0, U64)) == 0.0


def test_signatures_estimate_the_similarity():
    r = random.Random(1)
    words = ["w%d" % i for i in range(400)]
    errors = []
    for share in (0.5, 0.7, 0.9):
        for _ in range(15):
            a = r.sample(words, 200)
            b = [w if r.random() < share ** 0.2 else "x" + w for w in a]
            texts = pa.array([" ".join(a), " ".join(b)])
            doc, shingle, weight = weighted_shingles(texts)
            sign = signatures(2, doc, shingle, weight)
            errors.append((sign[0] == sign[1]).mean() - plain_similarity(shingles(texts[0].as_py()), shingles(texts[1].as_py())))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 5 * 0.5 / REGISTERS**0.5


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (7, 200)] + [(300, k) for k in range(301, 360)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 200: 0, 100: 100, 101: 100, 102: 100, **{k: 300 for k in range(300, 360)}}
