"""A whole run: extract, analyze, persist, aggregate."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide import vocab as V
from tickertide.functions.scoring import TextScorer
from tickertide.operators.mentions import find_mentions
from tickertide.operators.summaries import GRAINS
from tickertide.plans.state import RUN, RunState
from tickertide.session import cut_lineage, drop_written, written
from tickertide.sources.messages import scan_messages
from tickertide.sources.snapshots import Snapshots
from tickertide.sources.tables import (
    accumulated,
    create_tables,
    mentions_append_new,
    numbered,
    read_table,
    refreshed,
    table_exists,
    with_event_date,
)

STAGES = ("extract", "analyze", "persist", "aggregate")


def open_days(spark: SparkSession, root: str) -> DataFrame:
    """Days of batches that began to be saved and did not end: batch, event_date."""
    path = f"{root}/batches"
    if not table_exists(spark, path):
        return spark.createDataFrame([], "batch string, event_date date")
    log = spark.read.schema(schemas.BATCHES).parquet(path)
    ended = log.where("done").select("batch")
    return log.where("not done").join(ended, "batch", "left_anti").select("batch", "event_date")


def log_batch(days: DataFrame, root: str, done: bool) -> None:
    days.select("batch", "event_date", F.lit(done).alias("done")).coalesce(1).write.mode("append").parquet(f"{root}/batches")


def save_batch(spark: SparkSession, root: str, mentions: DataFrame, mode: str = "exact") -> None:
    """Append new mentions and bring the summaries up to date. ``mentions`` is read several
    times.

    In mode ``exact`` every period the batch touches is recomputed from the stored
    mentions. In mode ``accumulate`` the mentions that were new are added to stored sums,
    and old mentions are read only where there are no sums. Both keep the sums, so modes may
    alternate. A log says which days a batch touches before it does and when it is done:
    days of a batch that failed in between are recomputed by the next one, whatever its
    mode, so a repeated batch adds nothing. All summaries and their sums change in one
    commit; if another writer changed the same days meanwhile, ``Conflict`` is raised and
    the batch stays open.
    """
    if mentions.isEmpty():
        return
    days = with_event_date(mentions, "created_at").select("event_date").distinct()
    days = cut_lineage(days.withColumn("batch", F.lit(uuid.uuid4().hex)).select("batch", "event_date"))
    unfinished = cut_lineage(open_days(spark, root))
    store = Snapshots(spark, root)
    base = store.current()
    log_batch(days, root, done=False)
    added = mentions_append_new(spark, root, mentions, keep_added=mode == "accumulate")
    touched = days.unionByName(unfinished)
    adding = mode == "accumulate" and unfinished.isEmpty()
    changes = []
    for grain in GRAINS.values():
        changes += accumulated(spark, root, added, grain, base) if adding else refreshed(spark, root, touched, grain)
    store.commit(changes, base)
    log_batch(touched, root, done=True)


def run_report(tables: dict[str, DataFrame], status: str = "success") -> DataFrame:
    """One row: number of rows per table and the status of the run."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy().pivot("name", list(tables)).agg(F.first("n")).withColumn(
        "status", F.lit(status)
    )


def run(
    spark: SparkSession,
    root: str,
    messages: DataFrame,
    universe: DataFrame | list[str],
    stages: Iterable[str] = STAGES,
    limit: int | None = None,
    hours_back: int | None = None,
    mode: str = "exact",
    arrival: str = "created_at",
    scorer: TextScorer | None = None,
    now: datetime | None = None,
    limits: V.TextLimits = V.WHOLE_TEXT,
    **by_id: object,
) -> DataFrame:
    """Run the wanted stages and report the rows of each table.

    ``stages`` may leave out later ones. ``hours_back`` replaces the stored watermark.
    ``arrival='ingestion_timestamp'`` does not lose messages that arrive late.
    ``mode='accumulate'`` adds to the stored summaries instead of recomputing the touched
    periods. ``limits`` cuts texts, which are read whole otherwise. Watermarks move to the start of the run, and only after it has succeeded.
    ``by_id`` is ``row_id`` and ``fetch`` of ``dedup.first_rows``.
    """
    wanted = set(stages)
    state = RunState(spark, f"{root}/etl_state")
    started = now or datetime.now(timezone.utc)
    create_tables(spark, root)

    last = state.step_watermark("extraction")
    if hours_back is not None:
        last = started - timedelta(hours=hours_back)
    messages = scan_messages(messages, last, limit, arrival=arrival, **by_id)
    finished = ["extraction"]
    if "analyze" not in wanted:
        report = run_report({"messages": messages})
    else:
        # One pass over the messages, so they can be counted on the way.
        read = Observation()
        messages = messages.observe(read, F.count("*").alias("n"))
        mentions = written(numbered(find_mentions(messages, universe, scorer, limits)), "mentions")
        tables = {"mentions": mentions}
        finished.append("analysis")
        if "persist" in wanted and "aggregate" in wanted:
            save_batch(spark, root, mentions, mode)
            finished = list(V.STEPS)
            tables |= {g: read_table(spark, root, f"stock_{g}_summary") for g in GRAINS}
        elif "persist" in wanted:
            mentions_append_new(spark, root, mentions)
            finished.append("stock_persistence")
        report = run_report(tables).select(F.lit(read.get["n"]).cast("bigint").alias("messages"), "*")
        # The mentions are stored, or only their number is wanted.
        report = cut_lineage(report)
        drop_written(mentions)
    state.advance(*finished, RUN, moment=started)
    return report
