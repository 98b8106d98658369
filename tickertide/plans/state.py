"""Run state: when each step last ran.

The table is an append-only log with one small row per change. The newest entry of a step
counts; an entry without a time means that the next run reads everything.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide import vocab as V
from tickertide.sources.tables import table_exists

RUN = "run"


class RunState:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def log(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schemas.RUN_STATE)
        return self.spark.read.schema(schemas.RUN_STATE).parquet(self.path)

    def all_watermarks(self) -> DataFrame:
        """Current time of every step that has one."""
        return current_watermarks(self.log()).where(F.col("last_run").isNotNull())

    def step_watermark(self, step: str) -> datetime | None:
        """Last run of a step; None if there was none."""
        rows = self.all_watermarks().where(F.col("step") == step).select("last_run").head(1)
        return rows[0].last_run if rows else None

    def run_watermark(self) -> datetime | None:
        return self.step_watermark(RUN)

    def advance(self, *steps: str, moment: datetime | None = None) -> datetime:
        """Record a run of the steps, or of the whole run, by default of now."""
        now = datetime.now(timezone.utc)
        moment = moment or now
        self._append([(step, moment, now) for step in steps or (RUN,)])
        return moment

    def reset(self) -> None:
        """Forget all runs; the next one reads everything."""
        now = datetime.now(timezone.utc)
        self._append([(s, None, now) for s in (RUN, *V.STEPS)])

    def _append(self, rows: list[tuple[str, datetime | None, datetime]]) -> None:
        entries = self.spark.createDataFrame(rows, schemas.RUN_STATE)
        entries.coalesce(1).write.mode("append").parquet(self.path)


def current_watermarks(log: DataFrame) -> DataFrame:
    """Newest entry per step."""
    newest = F.max(F.struct("updated_at", "last_run")).alias("e")
    return log.groupBy("step").agg(newest).select("step", "e.last_run", "e.updated_at")


class ThreadState:
    """The last discussion thread that was read, and when, for each source."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def last(self, source: str = V.DEFAULT_SOURCE) -> tuple[str | None, datetime | None]:
        """Id of the thread and time of the last check; (None, None) before the first."""
        if not table_exists(self.spark, self.path):
            return None, None
        log = self.spark.read.schema(schemas.THREAD_STATE).parquet(self.path)
        newest = F.max(F.struct("last_updated", "last_daily_discussion_id")).alias("e")
        row = log.where(F.col("source") == source).agg(newest).head()
        return (row.e.last_daily_discussion_id, row.e.last_updated) if row.e else (None, None)

    def save(self, thread_id: str, moment: datetime | None = None, source: str = V.DEFAULT_SOURCE) -> None:
        moment = moment or datetime.now(timezone.utc)
        entry = self.spark.createDataFrame([(source, thread_id, moment)], schemas.THREAD_STATE)
        entry.coalesce(1).write.mode("append").parquet(self.path)
