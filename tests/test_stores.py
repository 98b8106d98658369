"""Commits of several tables, the key index, and staged documents as a stream."""

import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide.operators.clean import normalize_message
from tickertide.plans import run as R
from tickertide.session import prepare, shared_folder
from tickertide.sources import tables
from tickertide.sources.files import names
from tickertide.sources.keys import KeyIndex
from tickertide.sources.snapshots import Conflict, Snapshots
from tickertide.streaming import staging
from tickertide.streaming.incremental import incremental
from tickertide.streaming.staging import ingest_stream, staged_stream


def mention(message, ticker, day, sentiment=0.5, text="to the moon"):
    return {"message_id": message, "ticker": ticker, "created_at": datetime(2024, 1, day) if day else None, "sentiment_compound": sentiment,
            "signals": ["BUY"], "confidence": 0.5, "context": text, "subreddit": "s", "etl_timestamp": datetime(2024, 2, 1)}


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.STOCK_MENTIONS)


def counts(spark, root):
    return {
        name: {(r.ticker, str(r[1])): r[2] for r in tables.read_table(spark, root, f"stock_{name}_summary").select("ticker", period, "mention_count").collect()}
        for name, period in (("daily", "date"), ("hourly", "hour_start"), ("weekly", "week_start"))
    }


def test_readers_see_all_of_a_batch_or_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    tables.create_tables(spark, root)
    R.save_batch(spark, root, frame(spark, [mention("a", "AMD", 1), mention("b", "AMD", 2), mention("n", "AMD", None)]))
    before = counts(spark, root)
    more = frame(spark, [mention("c", "AMD", 2), mention("d", "TSLA", 3)])
    stage, calls = Snapshots.stage, []

    def stops(self, table, *rest):
        calls.append(table)
        if table == "stock_daily_summary":  # its sums are written already
            raise OSError("stopped")
        return stage(self, table, *rest)

    monkeypatch.setattr(Snapshots, "stage", stops)
    with pytest.raises(OSError):
        R.save_batch(spark, root, more)
    assert "stock_daily_summary_sums" in calls and counts(spark, root) == before
    monkeypatch.setattr(Snapshots, "stage", stage)
    R.save_batch(spark, root, more, "accumulate")
    after = counts(spark, root)
    assert after["daily"] == {("AMD", "2024-01-01"): 1, ("AMD", "2024-01-02"): 2, ("TSLA", "2024-01-03"): 1}  # no day, no period
    assert sum(after["hourly"].values()) == sum(after["weekly"].values()) == 4
    store = Snapshots(spark, root)
    assert store.versions() == [1, 2]
    old = store.read("stock_daily_summary", schemas.STOCK_DAILY_SUMMARY, store.at(1))
    assert old.count() == len(before["daily"])
    assert store.drop_old(keep=1) > 0 and store.versions() == [2] and counts(spark, root) == after


def test_two_writers(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    kind, day = "day string, v int", F.to_date("day")
    rows = lambda v, *days: spark.createDataFrame([(d, v) for d in days], kind)
    read = lambda: sorted((r.day, r.v) for r in store.read("t", kind).collect())
    base = store.current()
    assert base.version == 0 and read() == []
    first = store.commit([store.stage("t", rows(1, "2024-01-01", "2024-01-02"), day)], base)
    theirs = store.stage("t", rows(2, "2024-01-02"), day)
    mine = store.stage("t", rows(3, "2024-01-02", "2024-01-03"), day)
    apart = store.stage("t", rows(4, "2024-01-04"), day)
    store.commit([theirs], first)
    with pytest.raises(Conflict):
        store.commit([mine], first)
    assert store.commit([apart], first).version == 3
    assert read() == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-04", 4)]
    store.commit([mine._replace(days={"2024-01-01": None})], store.current())
    assert read() == [("2024-01-02", 2), ("2024-01-04", 4)]
    assert not store._create(4, "{}") and not [n for n in os.listdir(store.log) if n.startswith(".") and not n.endswith(".crc")]


def test_key_index(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), buckets=8)
    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "key string")
    assert not index.exists() and index.stored(keys("a")).count() == 0
    index.finish(index.add(spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))))
    index.finish(index.add(keys("é", "", None, "k5")))
    index.add(keys("not finished"))
    again = KeyIndex(spark, str(tmp_path))
    assert again.buckets == 8 and len(again.generations()) == 2 and len(again.pending()) == 1
    for one in (index, again):
        assert sorted(r.key for r in one.stored(keys("k7", "k19999", "é", "", "k5", "new", None, "not finished")).collect()) == ["", "k19999", "k5", "k7", "é"]
    fresh = spark.range(3000).select(F.concat(F.lit("new"), "id").alias("key"))
    assert again.possible(fresh).count() < 60
    # Only folders of the buckets asked for are read.
    plan = again.keys(again.generations(), [3])._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    again.compact()
    assert len(again.generations()) == 1 and again.stored(spark.range(25000).select(F.concat(F.lit("k"), "id").alias("key"))).count() == 20000


def test_append_moves_contexts_to_their_day_only(spark, tmp_path, monkeypatch):
    """Contexts lie where the batch had them until they are written by day."""
    root, plans, write = str(tmp_path / "root"), [], tables.written
    tables.create_tables(spark, root)

    def spied(df, name):
        if "context" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(tables, "written", spied)
    first = [mention("a", "AMD", 1), mention("a", "AMD", 2), mention("b", None, 1)]
    tables.mentions_append_new(spark, root, frame(spark, first))
    again = frame(spark, [*first, mention("c", "AMD", 2), mention("c", "AMD", 3)])
    added = tables.mentions_append_new(spark, root, again, keep_added=True)
    assert [r.message_id for r in added.collect()] == ["c"]
    assert sorted(r.message_id for r in tables.read_table(spark, root, "stock_mentions").collect()) == ["a", "b", "c"]
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)


def test_append_after_one_that_did_not_end(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    tables.create_tables(spark, root)
    first = [mention("a", "AMD", 1), mention("b", None, 1), mention("b", None, 1), mention("b", None, 1, text="other")]
    tables.mentions_append_new(spark, root, frame(spark, first))
    assert tables.read_table(spark, root, "stock_mentions").count() == 3
    second = frame(spark, [mention("a", "AMD", 2), mention("c", "AMD", 2), mention("b", None, 1)])
    write = tables.partition_and_cluster

    def fails(*_args, **_more):
        raise OSError("stopped")

    monkeypatch.setattr(tables, "partition_and_cluster", fails)
    with pytest.raises(OSError):
        tables.mentions_append_new(spark, root, second)  # keys are in the index, rows are not

    def ends_late(*args, **more):
        write(*args, **more)
        raise OSError("stopped")

    monkeypatch.setattr(tables, "partition_and_cluster", ends_late)
    with pytest.raises(OSError):
        tables.mentions_append_new(spark, root, second)  # rows are stored, the end is not marked
    monkeypatch.setattr(tables, "partition_and_cluster", write)
    added = tables.mentions_append_new(spark, root, second, keep_added=True)
    assert added.count() == 0 and tables.read_table(spark, root, "stock_mentions").count() == 4
    asked = spark.createDataFrame([("a", "AMD"), ("a", "TSLA"), ("c", "AMD"), (None, "AMD"), ("b", None)], "message_id string, ticker string")
    found = tables.mentions_exist(spark, root, asked).collect()
    assert {(r.message_id, r.ticker): r.found for r in found} == {
        ("a", "AMD"): True, ("a", "TSLA"): False, ("c", "AMD"): True, (None, "AMD"): False, ("b", None): False}


DOCUMENT = "document_id string, id string, content string, created_at string, timestamp double, score bigint"


def put(spark, folder, rows):
    spark.createDataFrame(rows, DOCUMENT).coalesce(1).write.mode("append").json(folder)


def stored(spark, root):
    rows = spark.read.schema(f"{schemas.RAW_MESSAGES}, event_date date").parquet(f"{root}/raw_messages")
    return sorted((r.document_id, r.message_id or "", r.content, r.score) for r in rows.collect())


def drain(spark, root, folder, archive, progress):
    stream = staged_stream(spark, folder, DOCUMENT, archive, files_per_batch=1)
    started = ingest_stream(stream, root, progress, normalize_message).trigger(availableNow=True).start()
    started.awaitTermination()


def test_staged_stream(spark, tmp_path, monkeypatch):
    root, folder, archive, progress, plain = (str(tmp_path / n) for n in ("root", "in/staged", "done", "progress", "plain"))
    batches = [
        [("d1", "m1", "one", "2024-01-01T00:00:00Z", 1.7e9, 1), ("d2", None, "no id", None, None, None)],
        [("d3", "m1", "one again", "2024-01-02T00:00:00Z", 1.7e9 + 2e5, 2), ("d4", "m2", "[deleted]", None, 1.7e9, 0)],
        [("d5", "m3", "three", "bad time", 1.7e9, None)],
    ]
    put(spark, folder, batches[0])
    drain(spark, root, folder, archive, progress)
    put(spark, folder, batches[1])
    # Killed after the merge, before the batch counts as processed.
    merge = staging.merge_raw

    def killed(*args):
        merge(*args)
        raise OSError("killed")

    monkeypatch.setattr(staging, "merge_raw", killed)
    with pytest.raises(StreamingQueryException):
        drain(spark, root, folder, archive, progress)
    waiting = [n for n in os.listdir(folder) if n.endswith(".json")]
    assert waiting  # what was not processed is not acknowledged
    monkeypatch.setattr(staging, "merge_raw", merge)
    put(spark, folder, batches[2])
    drain(spark, root, folder, archive, progress)
    for rows in batches:
        tables.ingest_raw(spark, plain, normalize_message(spark.createDataFrame(rows, DOCUMENT)))
    assert stored(spark, root) == stored(spark, plain)
    put(spark, folder, [])
    drain(spark, root, folder, archive, progress)
    archived = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".json")]
    assert len(archived) >= 2 and stored(spark, root) == stored(spark, plain)


def spied(monkeypatch, *modules):
    """The tables with texts that these modules write on the way, as (path, columns)."""
    made = []
    for module in modules:
        def spy(df, name, write=module.written):
            table = write(df, name)
            if name in ("staged", "merged", "mentions"):
                made.append((table._written, df.columns))
            return table

        monkeypatch.setattr(module, "written", spy)
    return made


def all_gone(spark, made):
    there = names(spark, shared_folder(spark))
    return bool(made) and not any(path.split("/")[-1] in there for path, _ in made)


def test_ingest_keeps_texts_where_they_are_and_drops_its_tables(spark, tmp_path, monkeypatch):
    root, plans, write = str(tmp_path / "root"), [], tables.written

    def planned(df, name):
        if name == "staged":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(tables, "written", planned)
    made = spied(monkeypatch, tables)
    kind = [("d1", "m1", "one", "2024-01-01T00:00:00Z", 1.7e9, 1), (None, "m2", "two", None, 1.7e9, 2), ("d3", None, "three", None, None, 3)]
    docs = normalize_message(spark.createDataFrame(kind, DOCUMENT))
    tables.ingest_raw(spark, root, docs)
    read = lambda: sorted((r.content, r.score) for r in spark.read.schema(schemas.RAW_MESSAGES).parquet(f"{root}/raw_messages").collect())
    assert len(read()) == 3
    more = [*kind, ("d4", "m1", "four", "2024-01-03T00:00:00Z", 1.7e9 + 2e5, 4), ("d1", "m9", "processed", None, 1.7e9, 9)]
    tables.ingest_raw(spark, root, normalize_message(spark.createDataFrame(more, DOCUMENT)))
    assert read() == [("four", 4), ("three", 3), ("two", 2)]
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    assert all_gone(spark, made)


def test_ingest_stream_drops_its_tables(spark, tmp_path, monkeypatch):
    root, folder, archive, progress = (str(tmp_path / n) for n in ("root", "in/staged", "done", "progress"))
    made = spied(monkeypatch, tables, staging)
    put(spark, folder, [("d1", "m1", "one", "2024-01-01T00:00:00Z", 1.7e9, 1)])
    drain(spark, root, folder, archive, progress)
    assert [r[0] for r in stored(spark, root)] == ["d1"] and all_gone(spark, made)


MESSAGE = ("message_id string, content string, author string, created_at timestamp, subreddit string, title string, url string, "
           "score bigint, message_type string, timestamp timestamp, n bigint")


def some_messages(spark):
    day = datetime(2024, 1, 3)
    return spark.createDataFrame([("a", "buy AMD", "x", day, "s", None, "u", 1, "REDDIT_COMMENT", day, 1),
                                  ("b", "sell TSLA and AMD", "x", None, "s", None, "u", 1, "REDDIT_COMMENT", None, 2)], MESSAGE)


def test_mentions_are_written_once_by_a_stream(spark, tmp_path, monkeypatch):
    import tickertide.streaming.incremental as stream_module

    root, files = str(tmp_path / "root"), str(tmp_path / "files")
    tables.create_tables(spark, root)
    some_messages(spark).write.parquet(files)
    made, again = spied(monkeypatch, stream_module), spied(monkeypatch, tables)
    for i in range(2):
        stream = spark.readStream.schema(MESSAGE).parquet(files)
        writer = incremental(stream, root, ["AMD", "TSLA"], str(tmp_path / f"progress{i}"), row_id="n")
        writer.trigger(availableNow=True).start().awaitTermination()
    assert tables.read_table(spark, root, "stock_mentions").count() == 3
    assert len(made) == 2 and not again and all_gone(spark, made)


def test_run_drops_its_mentions(spark, tmp_path, monkeypatch):
    made, again = spied(monkeypatch, R), spied(monkeypatch, tables)
    for mode in ("exact", "accumulate"):
        report = R.run(spark, str(tmp_path / mode), some_messages(spark), ["AMD", "TSLA"], mode=mode).head()
        assert (report.messages, report.mentions, report.hourly) == (2, 3, 1)
    assert len(made) == 2 and not again and all_gone(spark, made)


def test_days_are_written_in_groups(spark, tmp_path, monkeypatch):
    days = [1, 1, 1, 2, 3, 3, 4, None, None]
    kind = "v int, timestamp timestamp"
    df = spark.createDataFrame([(i, datetime(2024, 1, d) if d else None) for i, d in enumerate(days)], kind)
    dated = tables.with_event_date(df, "timestamp")
    text = lambda groups: [[str(d)[-1] if d else None for d in g] for g in groups]
    assert text(tables.day_groups(dated, rows=3, most=9)) == [[None, "1"], ["2", "3"], ["4"]]
    assert text(tables.day_groups(dated, rows=1, most=2)) == [[None, "1"], ["2", "3", "4"]]
    assert text(tables.day_groups(dated)) == [[None, "1", "2", "3", "4"]] and tables.day_groups(dated.limit(0)) == []
    groups = tables.day_groups
    monkeypatch.setattr(tables, "day_groups", lambda d: groups(d, rows=2))
    path = str(tmp_path / "days")
    tables.partition_and_cluster(df, path)
    read = lambda: sorted((r.v, str(r.event_date)) for r in spark.read.schema(f"{kind}, event_date date").parquet(path).collect())
    assert read() == sorted((i, f"2024-01-0{d}" if d else "None") for i, d in enumerate(days))
    tables.partition_and_cluster(df.where("v in (3, 4)").withColumn("v", F.col("v") + 10), path, mode="overwrite")
    assert [v for v, _ in read()] == [0, 1, 2, 6, 7, 8, 13, 14]


def test_exchanged_rows_do_not_wait_for_the_drivers_garbage(spark):
    assert prepare(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
