"""Whitened vectors against plain numpy on the distinct rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickertide.llm.q12 import op12_whitening
from tickertide.llm.whitening import LARGEST, cross_products, whiten

SCHEMA = "vec_id bigint, embedding array<float>, row string, n int, y int"


def plain(vectors):
    """x of each usable vector, the sums, and the eigenvalues with their axes."""
    keep = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(map(len, keep))
    xs = [tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in [*v, *[0.0] * (width - len(v))]) for v in keep]
    fit = np.array(sorted(set(xs)), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    d = fit * n - sums
    cov = np.array([[float(Fraction(int(x), n**3)) for x in r] for r in d.T @ d])
    values, axes = np.linalg.eigh(cov)
    return xs, n, sums, values[::-1], axes[:, ::-1], np.trace(cov)


def some_vectors(count=300, width=20):
    pick = np.random.default_rng(5)
    base = pick.normal(size=(count, 4)) @ pick.normal(size=(4, width)) + pick.normal(size=(count, width)) * 0.2
    vectors = [list(map(float, v)) for v in base]
    vectors += [vectors[7]] * 90 + [None, [], [None] * width, [float("nan")] * width, [1.0] * (width - 1) + [float("inf")]]
    vectors += [vectors[3][:5], [*vectors[3][:5], *[0.0] * (width - 5)]]
    return vectors


def test_against_numpy(spark):
    vectors = some_vectors()
    rows = [(i % 250, v, "r", 1, 2) for i, v in enumerate(vectors)]
    got = whiten(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got.select("row.*").columns == ["vec_id", "embedding", "row", "n", "y"]
    xs, n, sums, values, axes, trace = plain(vectors)
    found = got.select("row.embedding", "n", "deviation", "whitened", "explained", "identity_error").collect()
    assert len(found) == len(xs)
    by_x = {x: (np.array(x, dtype=object) * n - sums) for x in xs}
    signs = None
    for r in found:
        v = r.embedding
        x = tuple(math.floor(64 * c) + 1000000 for c in [*v, *[0.0] * (20 - len(v))])
        d = by_x[x]
        assert r.n == n and int(r.deviation) == int((d * d).sum())
        want = (d.astype(float) / n) @ axes[:, :16] / np.sqrt(values[:16])
        if signs is None:
            signs = np.sign(want) * np.sign(r.whitened)
        assert np.allclose(want * signs, r.whitened, rtol=1e-6, atol=1e-8)
        assert np.allclose(r.explained, values[:16] / trace, rtol=1e-9) and r.identity_error < 1e-8


@pytest.mark.parametrize("top", [0, 1, 5, 100, 3 * 2**30, 2**41])
def test_products_are_exact(top):
    pick = random.Random(top)
    rows = [[pick.randint(-LARGEST, -LARGEST + top) if j % 2 else pick.randint(0, top) for j in range(5)] for _ in range(130)]
    sums, products = cross_products(np.array(rows, np.int64))
    assert sums == [sum(r[j] for r in rows) for j in range(5)]
    assert products == [[sum(r[i] * r[j] for r in rows) for j in range(i + 1)] for i in range(5)]


def test_huge_entries_and_no_variance(spark):
    rows = [(1, [3e38, 1.0, 5.0], "a", 0, 0), (2, [-3e38, 1.0, 5.0], "a", 0, 0), (3, [0.0, 1.0, 5.0], "a", 0, 0)]
    got = {r["row"].vec_id: r for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert int(got[1].deviation) == (3 * LARGEST) ** 2 and int(got[3].deviation) == 0
    assert got[1].whitened[1:] == [None, None] and abs(abs(got[1].whitened[0]) - math.sqrt(1.5)) < 1e-9
    one = whiten(spark.createDataFrame(rows[:1] * 3, SCHEMA)).collect()
    assert len(one) == 3 and all(r.n == 1 and int(r.deviation) == 0 and r.whitened == [None] * 3 for r in one)


@pytest.mark.parametrize("rows", [[], [(1, None, "a", 0, 0), (2, [], "a", 0, 0)]])
def test_nothing_to_fit(spark, rows):
    got = whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 0 and got.columns == ["row", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query(spark, sf_dir):
    got = op12_whitening(spark, sf_dir)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    xs, n, sums, values, axes, trace = plain([r.embedding for r in vectors])
    assert got.count() == 16 * len(xs)
    row = got.agg(F.max("n"), F.max("identity_error"), F.max("component"), F.sum("explained")).first()
    assert row[0] == n and row[1] < 1e-4 and row[2] == 16
    assert abs(row[3] / len(xs) - values[:16].sum() / trace) < 1e-9
