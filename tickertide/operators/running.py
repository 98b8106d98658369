"""Running sums over ordered groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.session import cut_lineage


def running_sums(rows: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the earlier rows of their group as ``name``, 0
    for the first.

    A group may hold most of the rows: these are cut into ranges by group and order, summed
    within each range, and a group that goes on over several ranges adds what its earlier
    ranges hold. Only the group at a cut does, so the rows broadcast are fewer than the
    ranges. Rows are ordered upwards, nulls first; a null group is a group. Rows that tie are
    in any order, so ``order`` should end with a unique column.
    """
    cut = cut_lineage(rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    held = cut.groupBy(group, "_range").agg(F.sum(value).alias("_held"))
    ranges = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select(
        F.col(group).alias("_group"), F.col("_range").alias("_to"), F.sum("_held").over(ranges).alias("_carried")
    ).where(F.col("_carried").isNotNull())
    same: list[Column] = [F.col(group).eqNullSafe(F.col("_group")), F.col("_range") == F.col("_to")]
    out = summed.join(F.broadcast(carried), reduce(Column.__and__, same), "left")
    return out.withColumn(name, F.col(name) + F.coalesce("_carried", F.lit(0))).drop("_group", "_to", "_carried", "_range")
