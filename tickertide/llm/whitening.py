"""Whitening of embeddings with exact cross-products from bit planes.

Entries become whole numbers, x = floor(scale * c) + shift. The fit list has each different x
vector once. A task takes a block of it, subtracts each dimension's smallest entry in the
block, and packs every bit of every dimension across the rows into 64-bit words. The product
of two dimensions is the sum over their bit planes a and b of 2^(a+b) times the ones in
plane a AND plane b, which whole numbers hold exactly; what was subtracted is added back by
the sums. Spark adds the blocks up as decimals, so the result does not depend on how rows
lie. From the sums S and products G over n rows, n*G - S*S^T are the products of the centred
whole numbers n*x - S, exact as well, and only their eigenvectors are computed in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.shared import shared_path

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = 1 << 40  # entries of x - shift beyond this count as this
BLOCK = 8192  # rows packed at once, 128 words to a plane
LEAST = 1e-12  # share of the trace below which an eigenvalue is rounding of zero

SUMS = "i int, j int, total decimal(38,0)"
WHITE = "deviation decimal(38,0), whitened array<double>"


class Model(NamedTuple):
    """What the fit list says: rows, sums of x - shift, and components as columns."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def whole_numbers(vectors: DataFrame, column: str, scale: int = SCALE) -> DataFrame:
    """Rows whose vector has only finite entries, as struct ``row``, and ``y``: floor(scale * entry)."""
    values = F.transform(F.col(column), lambda c: c.cast("double"))
    bad = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(LARGEST)
    floor = F.transform(values, lambda c: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * scale))))
    rows = vectors.select(F.struct("*").alias("row"), F.when(F.col(column).isNotNull() & ~bad, floor).alias("y"))
    return rows.where(F.col("y").isNotNull())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def planes(rest: np.ndarray, bits: int) -> np.ndarray:
    """Bit ``b`` of dimension ``j`` of all rows as packed words: shape (bits, dimensions, words)."""
    words = -(-len(rest) // 64)
    out = np.zeros((bits, rest.shape[1], words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits(((rest >> b) & 1).astype(np.uint8), axis=0)
        out[b, :, : len(packed)] = packed.T
    return out.view(np.uint64)


def cross_products(block: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and products of the columns of a block of whole numbers."""
    low = block.min(axis=0)
    rest = block - low
    bits = max(1, int(rest.max()).bit_length())
    ones = planes(rest, bits)
    width, words = ones.shape[1:]
    weights = np.zeros((2 * bits - 1, width, width), np.int64)
    step = max(1, (1 << 19) // max(1, width * width))  # words whose ANDs are held at once
    for a in range(bits):
        for b in range(a, bits):
            both = np.zeros((width, width), np.int64)
            for w in range(0, words, step):
                left, right = ones[a, :, None, w : w + step], ones[b, None, :, w : w + step]
                both += np.bitwise_count(left & right).sum(axis=2, dtype=np.int64)
            weights[a + b] += both if a == b else both + both.T
    singles = np.bitwise_count(ones).sum(axis=2, dtype=np.int64)
    n = len(block)
    small = [sum(int(singles[b, j]) << b for b in range(bits)) for j in range(width)]
    lows = [int(x) for x in low]
    sums = [s + n * m for s, m in zip(small, lows)]
    products = [
        [
            sum(int(weights[k, i, j]) << k for k in range(2 * bits - 1)) + lows[i] * small[j] + lows[j] * small[i] + n * lows[i] * lows[j]
            for j in range(i + 1)
        ]
        for i in range(width)
    ]
    return sums, products


def add_up(width: int):
    """For each task: its rows as (-1, -1), sums of dimensions as (i, -1), products as (i, j), j <= i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = {}

        def add(i: int, j: int, x: int) -> None:
            totals[i, j] = totals.get((i, j), 0) + x

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = matrix(batch.column("y").slice(start, BLOCK), width)
                sums, products = cross_products(block)
                add(-1, -1, len(block))
                for i, row in enumerate(products):
                    add(i, -1, sums[i])
                    for j, x in enumerate(row):
                        add(i, j, x)
        if totals:
            pairs = np.array(list(totals), np.int32)
            values = pa.array([Decimal(x) for x in totals.values()], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), values], names=["i", "j", "total"])

    return run


def fit(fit_list: DataFrame, width: int, components: int) -> Model:
    """The components of a fit list (y), each of its vectors once."""
    totals = fit_list.mapInArrow(add_up(width), SUMS).groupBy("i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    found = {(r.i, r.j): int(r.total) for r in totals.collect()}  # a number for each pair of dimensions
    n = found[-1, -1]
    sums = [found[i, -1] for i in range(width)]
    cov = np.zeros((width, width))
    trace = Fraction(0)
    for i in range(width):
        for j in range(i + 1):
            exact = Fraction(n * found[i, j] - sums[i] * sums[j], n * n)
            cov[i, j] = cov[j, i] = float(exact)
            if i == j:
                trace += exact
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return Model(n, sums, axes, np.where(values > LEAST * float(trace), values, 0.0), float(trace))


def deviations(y: np.ndarray, model: Model) -> np.ndarray:
    """n*x - S of each row, exact; Python integers where 64 bits could overflow."""
    if max(int(np.abs(y).max(initial=0)) * model.n, *map(abs, model.sums)) >= 1 << 61:
        return y.astype(object) * model.n - np.array(model.sums, object)
    return y * model.n - np.array(model.sums, np.int64)


def project(y: np.ndarray, model: Model) -> np.ndarray:
    """Whitened rows; components without variance are NaN."""
    with np.errstate(divide="ignore", invalid="ignore"):
        scaled = model.axes / np.sqrt(model.values)
        scaled[:, model.values == 0] = np.nan
        return (deviations(y, model).astype(np.float64) / model.n) @ scaled


def squares(y: np.ndarray, model: Model) -> list[Decimal]:
    d = deviations(y, model)
    if d.dtype == object or float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 2.0**62:
        d = d.astype(object)
    return [Decimal(int(x)) for x in (d * d).sum(axis=1)]


def white(model: Model, column: Column) -> Column:
    width = len(model.sums)

    @F.arrow_udf(WHITE)
    def run(lists: pa.Array) -> pa.Array:
        y = matrix(lists, width)
        out = project(y, model)
        flat = pa.array(out.ravel(), pa.float64(), mask=np.isnan(out.ravel()))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * out.shape[1], pa.int32()), flat)
        return pa.StructArray.from_arrays([pa.array(squares(y, model), pa.decimal128(38, 0)), lists], ["deviation", "whitened"])

    return run(column)


def moments(model: Model, centre: np.ndarray | None):
    """Sums of the whitened fit list (j = -1), or of its products about a centre."""
    width, live = len(model.sums), np.flatnonzero(model.values > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            w = project(matrix(batch.column("y"), width), model)[:, live]
            total = total + (w.sum(axis=0)[:, None] if centre is None else (w - centre).T @ (w - centre))
        if isinstance(total, np.ndarray):
            i, j = (x.ravel() for x in np.indices(total.shape))
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "total"])

    return run


def identity_error(fit_list: DataFrame, model: Model) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    live = int((model.values > 0).sum())
    if not live:
        return 0.0

    def summed(centre: np.ndarray | None, columns: int) -> np.ndarray:
        rows = fit_list.mapInArrow(moments(model, centre), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
        out = np.zeros((live, columns))
        for r in rows.collect():
            out[r.i, r.j] = r.total
        return out / model.n

    return float(np.abs(summed(summed(None, 1)[:, 0], live) - np.eye(live)).max())


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Rows of vectors as struct ``row`` with n, deviation, whitened (one entry for each
    component), explained and identity_error.

    x is floor(scale * entry) + 1000000; the fit list has each different x vector once, n of
    them with sums S. deviation is the exact sum of (n*x - S)^2. Components are the unit
    eigenvectors of the fit list's covariance by falling eigenvalue e; whitened is x - S/n on
    each, over sqrt(e), and explained is e over the trace, for each component. A component
    without variance (e below 1e-12 of the trace) has null for whitened. identity_error is
    how far the whitened fit list's covariance is from the identity.

    Rows whose vector is null or has null, NaN or infinite entries are left out. Vectors
    shorter than the longest count as 0 in the entries they lack. scale * entry is held
    between -2^40 and 2^40. No vector left, or only empty ones: no rows. Rows that repeat stay
    and get equal results, and other columns travel along under any name.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, column, scale)
    width = rows.agg(F.max(F.size("y")).alias("width")).first()["width"]
    if not width:
        kinds = {"n": "bigint", "deviation": "decimal(38,0)", "whitened": "array<double>", "explained": "array<double>", "identity_error": "double"}
        return rows.where(F.lit(False)).select("row", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()])
    rows = rows.withColumn("y", F.concat("y", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("y"))))
    folder = shared_path(spark, "whitening")
    rows.select("y").distinct().write.parquet(f"{folder}/fit")
    fit_list = spark.read.parquet(f"{folder}/fit")
    model = fit(fit_list, width, components)
    error = identity_error(fit_list, model)
    explained = F.array(*[F.lit(float(v / model.trace) if model.trace else 0.0) for v in model.values])
    out = rows.withColumn("white", white(model, F.col("y")))
    return out.select("row", F.lit(model.n).cast("bigint").alias("n"), "white.*", explained.alias("explained"), F.lit(error).alias("identity_error"))
