"""Equi-join that spreads keys holding a large share of the left rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are never more
# than HOT_SHARE hot keys, whatever the size of the table.
HOT_SHARE = 1000
SAMPLE = 8
LEAST = 10  # rows of the sample below which a key is never hot


def row_hash(df: DataFrame, *without: str) -> Column:
    """A hash of the columns that can be hashed, which differs between different rows."""
    plain = [c for c, kind in df.dtypes if c not in without and "map" not in kind and "variant" not in kind]
    return F.xxhash64(*plain) if plain else F.spark_partition_id().cast("bigint")


def hot_keys(df: DataFrame, key: str, sample: int = SAMPLE) -> DataFrame:
    """At most ``HOT_SHARE`` keys, each with more than that share of the rows of a sample.

    Which keys are hot says how rows are spread, not what a join gives, so one row in
    ``sample``, chosen by hash, is enough.
    """
    some = df.where(F.col(key).isNotNull() & (F.pmod(row_hash(df), F.lit(sample)) == 0))
    counts = some.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.where((F.col("n") * HOT_SHARE > total) & (F.col("n") >= LEAST)).select(key)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Column | None = None,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key.

    Left rows of a hot key are spread by ``spread``, a hash that differs between them, and
    only the right rows of hot keys are repeated. By default they are spread by a hash of
    their other columns, so wherever they lie and when a task runs again. ``how`` is inner
    or left. ``hot`` may be given where it is known from an earlier join on the key.

    Adaptive execution splits a hot key only in joins that read both sides straight from
    an exchange, so not where one side was just ranked on the same key.
    """
    hot = F.broadcast((hot_keys(left, key) if hot is None else hot).withColumn("_hot", F.lit(True)))
    source = row_hash(left, key) if spread is None else spread
    # Rows without a key match nothing; spread as well, they do not pile up in one task.
    spread_out = F.col("_hot") | F.col(key).isNull()
    salt = F.when(spread_out, F.pmod(source, F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted = left.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    repeated = right.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def skew_semi_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys occur in ``right``; a null key occurs nowhere."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    packed = F.struct(*keys)
    wanted = right.select(packed.alias("_key")).distinct()
    return skew_join(left.where(known).withColumn("_key", packed), wanted, "_key").drop("_key")
