"""Tumbling windows of an hour, a day and a week over streams of mentions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.operators.dedup import first_rows
from tickertide.operators.summaries import Grain, measures


def tumbling(grain: Grain, time: str = "created_at") -> Column:
    """The window of a summary period. Weeks start on Monday, four days after the epoch."""
    if grain.name == "hourly":
        return F.window(time, "1 hour")
    if grain.name == "daily":
        return F.window(time, "1 day")
    return F.window(time, "7 days", "7 days", "4 days")


def window_totals(mentions: DataFrame, grain: Grain, delay: str | None = None) -> DataFrame:
    """Counts and exact sums per ticker and window, for streams and tables; ``means`` gives
    the metrics of a summary from them. Count maps and contexts are not sums and left out.

    ``delay`` is how late a row of a stream may come.
    """
    rows = mentions.withWatermark("created_at", delay) if delay else mentions
    totals = rows.withColumn("_main", F.lit(True)).groupBy("ticker", tumbling(grain).alias("w")).agg(*measures(grain))
    period = F.to_date("w.start") if grain.name == "daily" else F.col("w.start")
    return totals.select("ticker", period.alias(grain.period), *[c for c in totals.columns if c not in ("ticker", "w", "_rows")])


def write_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer for update mode. A batch that runs again overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def latest_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last update of every key."""
    return first_rows(updates, keys, [F.desc("batch_id")]).drop("batch_id")


def compact_updates(spark: SparkSession, path: str, target: str, keys: list[str]) -> DataFrame:
    """Write the last updates so far as a table, so that readers need not rank all updates."""
    latest_updates(spark.read.parquet(path), keys).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
