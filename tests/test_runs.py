"""Whole runs, state and streams."""

from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.operators import summaries as G
from tickertide.operators.mentions import find_mentions
from tickertide.plans import run as R
from tickertide.plans.state import RunState
from tickertide.registry import derived
from tickertide.registry.base import universe
from tickertide.session import scratch_path, size_shuffles
from tickertide.sources import tables
from tickertide.sources.messages import scan_messages
from tickertide.streaming.dedup import dedup_stream
from tickertide.streaming.incremental import incremental

CUT = derived.BATCH_CUT


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    path = scratch_path(spark, "raw")
    derived.raw_messages(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tickers(spark, sf_dir):
    return universe(spark, sf_dir)


def summaries(spark, root, drop=()):
    found = {}
    for name, grain in G.GRAINS.items():
        table = tables.read_table(spark, root, f"stock_{name}_summary").drop("etl_timestamp", "event_date", *drop)
        found[name] = [r.asDict(True) for r in table.orderBy(*grain.keys).collect()]
    return found


@pytest.fixture(scope="module")
def one_run(spark, messages, tickers):
    root = scratch_path(spark, "whole")
    report = R.run(spark, root, messages, tickers).head().asDict()
    return root, report, summaries(spark, root)


def test_report(spark, one_run, messages):
    _, report, stored = one_run
    assert report["status"] == "success"
    assert report["messages"] == scan_messages(messages).count()
    assert {n: report[n] for n in G.GRAINS} == {n: len(rows) for n, rows in stored.items()}


@pytest.mark.parametrize("mode", ["exact", "accumulate"])
def test_two_batches_equal_one_run(spark, messages, tickers, one_run, mode):
    root = scratch_path(spark, mode)
    early = messages.where(F.col("created_at") < CUT)
    first = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
    R.run(spark, root, early, tickers, mode=mode, now=first)
    R.run(spark, root, messages, tickers, mode=mode)
    assert summaries(spark, root) == one_run[2]


def test_same_batch_twice_changes_nothing(spark, messages, tickers, one_run):
    root, _, before = one_run
    mentions = tables.read_table(spark, root, "stock_mentions").count()
    RunState(spark, f"{root}/etl_state").reset()
    R.run(spark, root, messages, tickers)
    assert summaries(spark, root) == before
    assert tables.read_table(spark, root, "stock_mentions").count() == mentions


def test_late_messages(spark, messages, tickers, one_run):
    """Rows that arrive after a run but were created before it are found by arrival time."""
    # A late copy could bring other tickers.
    single = F.col("message_id") == F.concat(F.lit("m"), F.col("event_id"))
    single = single & ~F.col("message_id").isin([r[0] for r in messages.groupBy("message_id").count().where("count > 1").select("message_id").collect()])
    late = single & (F.col("event_id") % 97 == 0) & (F.col("created_at") < CUT)
    arrives = F.when(late, F.col("created_at") + F.expr("interval 20 days")).otherwise(F.col("created_at"))
    rows = messages.withColumn("ingestion_timestamp", arrives)
    root = scratch_path(spark, "late")
    first = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
    seen = rows.where(F.col("ingestion_timestamp") <= F.lit(first))
    R.run(spark, root, seen, tickers, arrival="ingestion_timestamp", now=first)
    R.run(spark, root, rows, tickers, arrival="ingestion_timestamp")
    assert summaries(spark, root)["weekly"] == one_run[2]["weekly"]


def test_stages(spark, messages, tickers):
    root = scratch_path(spark, "stages")
    report = R.run(spark, root, messages, tickers, stages=("extract", "analyze", "persist"), limit=50).head()
    assert report["messages"] == 50 and "hourly" not in report.asDict()
    assert tables.read_table(spark, root, "stock_mentions").count() == report["mentions"] > 0
    assert tables.read_table(spark, root, "stock_daily_summary").count() == 0
    steps = {r.step for r in RunState(spark, f"{root}/etl_state").all_watermarks().collect()}
    assert steps == {"extraction", "analysis", "stock_persistence", "run"}


def test_state(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "state"))
    assert state.run_watermark() is None
    first, second = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    state.advance("analysis", moment=first)
    state.advance("analysis", moment=second)
    state.advance("extraction", moment=first)
    assert state.step_watermark("analysis") == datetime(2024, 1, 2)
    assert state.all_watermarks().count() == 2 and state.step_watermark("daily_persistence") is None
    state.reset()
    assert state.all_watermarks().count() == 0 and state.step_watermark("analysis") is None
    state.advance(moment=first)
    assert state.run_watermark() == datetime(2024, 1, 1)
    assert len(V.STEPS) == 9


def test_custom_scorer(spark, messages, tickers):
    def always_positive(batches):
        for texts in batches:
            yield pd.DataFrame({"positive": [0.9] * len(texts), "negative": [0.1] * len(texts),
                                "neutral": [None] * len(texts)})

    got = find_mentions(scan_messages(messages), tickers, scorer=always_positive)
    kinds = got.select("sentiment_compound", "sentiment_positive", "sentiment_neutral").distinct().collect()
    assert [tuple(r) for r in kinds] == [(0.8, 0.9, 0.0)]


def test_incremental_stream(spark, messages, tickers, one_run):
    source, root = scratch_path(spark, "in"), scratch_path(spark, "tables")
    progress = scratch_path(spark, "progress")
    tables.create_tables(spark, root)

    def drain():
        stream = spark.readStream.schema(messages.schema).parquet(source)
        incremental(stream, root, tickers, progress).trigger(availableNow=True).start().awaitTermination()

    # Copies of a message lie in one part, so both ways keep the same copy.
    part = F.pmod(F.xxhash64("message_id"), F.lit(2))
    messages.where(part == 0).write.mode("append").parquet(source)
    drain()
    messages.where(part == 1).write.mode("append").parquet(source)
    drain()
    drain()
    assert summaries(spark, root) == one_run[2]


def test_dedup_stream_across_batches(spark, messages):
    source, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    for _ in range(2):
        messages.write.mode("append").parquet(source)
        stream = spark.readStream.schema(messages.schema).parquet(source)
        query = (
            dedup_stream(stream, "40 days").select("message_id").writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() == scan_messages(messages).count()


def test_failed_batch_is_put_right(spark, messages, tickers, one_run):
    """A batch that stops after its mentions are stored; the next one recomputes its days."""
    root = scratch_path(spark, "failed")
    tables.create_tables(spark, root)
    found = tables.read_table(spark, one_run[0], "stock_mentions").drop("event_date")
    early = found.where(F.col("created_at") < CUT)
    R.save_batch(spark, root, found.where("day(created_at) < 5"), "accumulate")
    days = early.select(F.to_date("created_at").alias("event_date")).distinct()
    R.log_batch(days.withColumn("batch", F.lit("stopped")), root, done=False)
    tables.mentions_append_new(spark, root, early)
    R.save_batch(spark, root, early, "accumulate")
    assert R.open_days(spark, root).isEmpty()
    R.save_batch(spark, root, found, "accumulate")
    assert summaries(spark, root) == one_run[2]


def test_partition_pruning(spark, messages):
    path = scratch_path(spark, "days")
    tables.partition_and_cluster(messages, path)
    day = spark.read.parquet(path).where("event_date = '2024-01-12'")
    assert len(day.inputFiles()) >= 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert spark.read.parquet(path).count() == messages.count()


def test_size_shuffles(spark):
    assert size_shuffles(spark, 10**12) == 7451
    assert size_shuffles(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
