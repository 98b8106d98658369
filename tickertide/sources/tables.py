"""Tables as Parquet folders: layout, appends, overwrites and upserts.

Nothing reads and overwrites a folder in one plan: raw messages are merged for the touched
partitions, written to a table of their own, and then over those partitions only;
summaries go to folders of their own and become visible by a commit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide.functions.values import json_text
from tickertide.operators.clean import drop_deleted
from tickertide.operators.dedup import numbered_rows
from tickertide.operators.merge import (
    affected_rows,
    contents,
    latest_per_key,
    raw_upsert,
    replace_upsert,
    staging_ack,
    with_etl_timestamp,
)
from tickertide.operators.summaries import Grain, accumulate, summarize, without_ids
from tickertide.operators.universe import listing_symbols, require_rows
from tickertide.session import cut_lineage, drop_written, written
from tickertide.sources.keys import KeyIndex
from tickertide.sources.listing import listing_scan
from tickertide.sources.snapshots import PARTITION, Change, Snapshot, Snapshots

# Partition column of each table and the time column it is the date of.
PARTITION_TIME = {
    "raw_messages": "timestamp",
    "stock_mentions": "created_at",
    "stock_daily_summary": "date",
    "stock_hourly_summary": "hour_start",
    "stock_weekly_summary": "week_start",
}
CLUSTER = ("source", "subreddit", "message_type")
ROW = "_number"
# Rows laid out by day at once, and into how many groups of days they are cut at most.
PASS_ROWS = 1 << 20
PASSES = 8


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def with_event_date(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(PARTITION, F.to_date(time))


def day_groups(dated: DataFrame, rows: int = PASS_ROWS, most: int = PASSES) -> list[list]:
    """The days (event_date) in calendar order, in groups of some ``rows`` rows, ``most`` at
    most. Only days are read, and there are no more of them than in the calendar."""
    counts = sorted(dated.groupBy(PARTITION).count().collect(), key=lambda r: (r[0] is not None, r[0]))
    size = max(rows, -(-sum(r[1] for r in counts) // most))
    groups: list[list] = []
    taken = size
    for day, n in counts:
        if taken >= size:
            groups.append([])
            taken = 0
        groups[-1].append(day)
        taken += n
    return groups


def in_days(days: Iterable) -> Column:
    """Rows of some days (event_date). A null day is a day like any other."""
    inside = F.col(PARTITION).isin([d for d in days if d is not None])
    return F.coalesce(inside, F.lit(False)) | F.col(PARTITION).isNull() if None in days else inside


def partition_and_cluster(df: DataFrame, path: str, time: str = "timestamp", mode: str = "append") -> None:
    """Write by day, sorted by the cluster columns inside each file.

    Rebalancing puts the rows of a day together and splits a day that is too large for
    one task, so neither many small files nor one huge file come out. Many rows are written
    some days after the other, so that only these days' rows, with their texts, are on their
    way at once. ``df`` is read once for each such group of days, and must not be what is
    overwritten.
    """
    dated = with_event_date(df, time)
    cluster = [c for c in CLUSTER if c in df.columns]
    groups = day_groups(dated)
    for days in groups or [[]]:
        (
            (dated.where(in_days(days)) if len(groups) > 1 else dated)
            .hint("rebalance", F.col(PARTITION))
            .sortWithinPartitions(PARTITION, *cluster)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION)
            .parquet(path)
        )


def create_like(df: DataFrame) -> DataFrame:
    """An empty frame with the schema of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Create the four result tables where they are missing; returns the created names."""
    created = []
    for name, schema in schemas.TABLES.items():
        path = f"{root}/{name}"
        if not table_exists(spark, path):
            empty = spark.createDataFrame([], schema)
            # One empty file at the top keeps the schema readable without any partition.
            empty.write.mode("ignore").parquet(path)
            created.append(name)
    return created


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A result table with its declared columns; the partition column stays for pruning.

    Of a table that changes by commits the newest snapshot is read."""
    store = Snapshots(spark, root)
    snapshot = store.current()
    if name in snapshot.tables:
        return store.read(name, schemas.TABLES[name], snapshot)
    schema = f"{schemas.TABLES[name]}, {PARTITION} date"
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def save_records(
    spark: SparkSession, records: DataFrame | Iterable, schema: str | None = None
) -> DataFrame:
    """Rows of a DataFrame or of dicts and objects with attributes, with ``etl_timestamp``.

    The latter are a handful of records a program holds; tables come as DataFrames.
    """
    if isinstance(records, DataFrame):
        return with_etl_timestamp(records)
    rows = []
    for record in records:
        if isinstance(record, (dict, Row)):
            rows.append(record if isinstance(record, dict) else record.asDict())
        elif hasattr(record, "__dict__"):
            rows.append(vars(record))
        else:
            raise TypeError(f"cannot store a {type(record).__name__}")
    return with_etl_timestamp(spark.createDataFrame(rows, schema))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> int:
    """Replace the table by ``df``, which does not read it. Returns the number of rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def same_periods(
    stored: DataFrame, batch: DataFrame, period: Callable[[Column], Column] = F.to_date
) -> DataFrame:
    """Rows of the stored table in the day folders of the periods that the batch touches.

    The periods are named one by one, so that only their folders are read; there are no
    more of them than days in the calendar. Rows without a time are in no period.
    """
    touched = period(F.col(PARTITION)).cast("date")
    periods = batch.select(touched.alias("period")).where("period is not null").distinct()
    return stored.where(touched.isin([r.period for r in periods.collect()]))


def mention_key(df: DataFrame) -> Column:
    """What a mention is known by: its message and ticker, or its contents where one is null."""
    same = [c for c in schemas.columns("stock_mentions") if c != "etl_timestamp"]
    known = F.concat_ws("\n", F.lit("id"), "message_id", "ticker")
    return F.when(F.col("message_id").isNotNull() & F.col("ticker").isNotNull(), known).otherwise(contents(df, same))


def mention_index(spark: SparkSession, root: str) -> KeyIndex:
    """The index of the stored mentions. It is made where it is missing, and mended after an
    append that did not end: of that one's keys those count whose mention is stored."""
    index = KeyIndex(spark, f"{root}/stock_mentions_keys")
    if not index.exists():
        stored = read_table(spark, root, "stock_mentions")
        if not stored.isEmpty():
            index.finish(index.add(stored.select(mention_key(stored).alias("key"))))
    pending = index.pending()
    if pending:
        stored = read_table(spark, root, "stock_mentions")
        keys = stored.select(mention_key(stored).alias("key"))
        index.finish(index.add(index.keys(pending).select("key").join(keys, "key", "left_semi")))
        index.drop(*pending)
    return index


def mentions_exist(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """``keys`` (message_id, ticker) with ``found``: whether the mention is stored."""
    asked = keys.withColumn("key", F.concat_ws("\n", F.lit("id"), "message_id", "ticker"))
    asked = asked.withColumn("key", F.when(F.col("message_id").isNotNull() & F.col("ticker").isNotNull(), F.col("key")))
    stored = mention_index(spark, root).stored(asked.select("key")).withColumn("found", F.lit(True))
    return asked.join(stored, "key", "left").select(*keys.columns, F.coalesce("found", F.lit(False)).alias("found"))


def mentions_append_new(
    spark: SparkSession, root: str, mentions: DataFrame, keep_added: bool = False
) -> DataFrame | None:
    """Append the mentions whose message and ticker are not stored.

    Copies of a message may have other dates, so the keys of all stored mentions count; they
    are asked of an index, which reads only what the batch may be in. A row with a null in
    its key is known by its other columns. With ``keep_added`` the added rows are returned.
    Mentions that were ``numbered`` before they were written are not written again.
    """
    index = mention_index(spark, root)
    batch = with_etl_timestamp(mentions)
    # Contexts are written once, where they are; keys and numbers travel.
    if ROW in mentions.columns:
        rows = batch.select(*schemas.columns("stock_mentions"), mention_key(batch).alias("key"), ROW)
    else:
        batch = batch.select(*schemas.columns("stock_mentions"))
        rows = written(numbered(batch.withColumn("key", mention_key(batch))), "mentions")
    small = rows.select("key", "etl_timestamp", *[c for c in ("url",) if c in rows.columns], ROW)
    ids, counted = latest_per_key(small, ["key"], ["etl_timestamp"])[0].select("key", ROW), Observation()
    if index.generations():
        ids = written(ids, "keys")
        ids = ids.join(index.stored(ids.select("key")), "key", "left_anti")
    ids = written(ids.observe(counted, F.count("*").alias("n")), "keys")
    n = counted.get["n"]
    added = numbered_rows(rows, ids, ROW).drop("key", ROW)
    if n:
        generation = index.add(ids.select("key"), n)
        partition_and_cluster(added, f"{root}/stock_mentions", "created_at")
        index.finish(generation)
    if keep_added:
        return added
    drop_written(rows)
    return None


def stage_sums(store: Snapshots, sums: DataFrame, grain: Grain) -> list[Change]:
    """Write the sums of a summary's periods, and from them the summary, for one commit."""
    table, day = f"stock_{grain.name}_summary", F.to_date(grain.period)
    kind = ", ".join(f"{n} {k}" for n, k in sums.dtypes)
    staged = store.stage(f"{table}_sums", sums, day)
    summary = without_ids(store.staged(staged, kind).select(*schemas.columns(table)))
    return [staged, store.stage(table, summary, day)]


def period_mentions(spark: SparkSession, root: str, days: DataFrame, grain: Grain) -> DataFrame:
    """Stored mentions of the periods that ``days`` (event_date) lie in."""
    period = grain.start if grain.name == "weekly" else F.to_date
    return same_periods(read_table(spark, root, "stock_mentions"), days, period)


def refreshed(spark: SparkSession, root: str, days: DataFrame, grain: Grain) -> list[Change]:
    """The changes of ``refresh_summary``, not committed yet."""
    rows = period_mentions(spark, root, days, grain)
    return stage_sums(Snapshots(spark, root), summarize(rows, grain, keep_sums=True), grain)


def refresh_summary(spark: SparkSession, root: str, days: DataFrame, grain: Grain) -> None:
    """Recompute the summary of every period that ``days`` touch, all tickers of it.

    Only the touched days are read and written, nothing stored is merged, and running it
    again gives the same table. The sums are kept beside it, for batches to be added; both
    change in one commit.
    """
    store = Snapshots(spark, root)
    base = store.current()
    store.commit(refreshed(spark, root, days, grain), base)


def accumulated(spark: SparkSession, root: str, added: DataFrame, grain: Grain, base: Snapshot) -> list[Change]:
    """The changes of ``accumulate_summary``, not committed yet."""
    store, name = Snapshots(spark, root), f"stock_{grain.name}_summary_sums"
    batch = cut_lineage(with_event_date(summarize(added, grain, keep_sums=True), grain.period))
    kind = ", ".join(f"{n} {k}" for n, k in batch.dtypes if n != PARTITION)
    if name not in base.tables:
        return stage_sums(store, summarize(period_mentions(spark, root, batch, grain), grain, keep_sums=True), grain)
    stored = same_periods(store.read(name, kind, base), batch)
    summed = stored.select(PARTITION).distinct()
    known = batch.join(summed, PARTITION, "left_semi").drop(PARTITION)
    total = accumulate(stored.drop(PARTITION), known, grain)
    # Periods that only have mentions.
    missing = cut_lineage(batch.select(PARTITION).distinct().join(summed, PARTITION, "left_anti"))
    if not missing.isEmpty():
        rest = summarize(period_mentions(spark, root, missing, grain), grain, keep_sums=True)
        total = total.unionByName(rest)
    return stage_sums(store, total, grain)


def accumulate_summary(spark: SparkSession, root: str, added: DataFrame, grain: Grain) -> None:
    """Add new mentions, which are stored already, to the sums of their periods.

    Old mentions are read only in periods that have no sums yet. The same mentions must not
    be added twice; see ``plans.run.save_batch``.
    """
    store = Snapshots(spark, root)
    base = store.current()
    store.commit(accumulated(spark, root, added, grain, base), base)


def summary_upsert(spark: SparkSession, root: str, name: str, batch: DataFrame, keys: list[str]) -> int:
    """Replace or add summary rows, rewriting the touched days only; one commit.

    Raises ``Conflict`` if another writer changed one of these days meanwhile; nothing is
    changed then. Returns the number of rows of the batch.
    """
    store, counted = Snapshots(spark, root), Observation()
    base = store.current()
    dated = with_event_date(with_etl_timestamp(batch), PARTITION_TIME[name])
    fresh = cut_lineage(dated.observe(counted, F.count("*").alias("n")))
    stored = same_periods(store.read(name, schemas.TABLES[name], base), fresh)
    merged = replace_upsert(stored, fresh, keys).drop(PARTITION)
    change = store.stage(name, merged, F.to_date(PARTITION_TIME[name]))
    store.commit([change], base)
    return counted.get["n"]


def current_path(spark: SparkSession, root: str) -> str | None:
    """Where the current version of a table lies; None if there is none."""
    log = f"{root}/versions"
    if not table_exists(spark, log):
        return None
    newest = spark.read.schema(schemas.VERSIONS).parquet(log).orderBy(F.desc("version")).head(1)
    return newest[0].path if newest else None


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version of the table at ``root`` and make it the current one.

    ``df`` may read the current version, which stays as it is. The entry in the log of
    versions comes last, so a write that fails changes nothing.
    """
    spark = df.sparkSession
    log = f"{root}/versions"
    last = spark.read.schema(schemas.VERSIONS).parquet(log).agg(F.max("version")).head()[0] if table_exists(spark, log) else None
    number = (last or 0) + 1
    path = f"{root}/version-{number}"
    df.write.mode("overwrite").parquet(path)
    entry = spark.createDataFrame([(number, path)], schemas.VERSIONS)
    entry.coalesce(1).write.mode("append").parquet(log)
    return path


def backup_truncate_reload(
    spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Replace a versioned table by a change of itself; returns it and the one before.

    The data are written once; the old version is the backup.
    """
    before = spark.read.parquet(current_path(spark, root))
    return spark.read.parquet(write_version(change(before), root)), before


def temp_result_table(df: DataFrame, path: str) -> int:
    """Write a result to a path of its own and count it there."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def merge_staged(stored: DataFrame, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages merged with the staged documents, and the counts of the merge.

    Deleted rows are not merged. Once the result is written, ``staging_ack`` gives the
    documents that still wait.
    """
    wanted = drop_deleted(staged)
    return raw_upsert(stored, wanted), affected_rows(stored, wanted)


def ingest_raw(spark: SparkSession, root: str, staged: DataFrame) -> Row:
    """Merge staged documents into the stored raw messages and acknowledge them.

    ``staged`` has the columns of ``normalize_message``. Deleted rows are not merged. Only
    the day folders that hold one of the messages, or will, are rewritten; which these are
    says a table of the keys and days of all messages. Documents count as processed once the
    merge is written. Running a batch again merges the same rows again, which changes
    nothing, and documents processed earlier are left out. Returns the counts of updated and
    inserted rows.
    """
    documents = written(numbered(staged), "staged")
    # Which of them wait is found out by their ids; the texts stay where they are written.
    ids = written(waiting(spark, root, documents.select("document_id", ROW)), "waiting")
    counts = merge_raw(spark, root, numbered_rows(documents, ids, ROW), documents)
    append(ids.select("document_id").where("document_id is not null"), f"{root}/staging_done")
    drop_written(ids)
    return counts


def numbered(batch: DataFrame) -> DataFrame:
    """Rows with a number that differs between them; fixed once they are written."""
    return batch.withColumn(ROW, F.monotonically_increasing_id())


def merge_raw(spark: SparkSession, root: str, batch: DataFrame, scratch: DataFrame | None = None) -> Row:
    """Merge a batch of documents, which is read several times, into the stored raw messages.

    See ``ingest_raw``; nothing is acknowledged here. Merging a batch again changes nothing.
    If the batch was ``numbered`` before it was written, its texts move once. ``scratch`` is
    the written table that the batch reads, which is dropped as soon as it is merged.
    """
    table, keys = f"{root}/raw_messages", f"{root}/raw_message_days"
    if not table_exists(spark, table):
        spark.createDataFrame([], schemas.RAW_MESSAGES).write.mode("ignore").parquet(table)
    if not table_exists(spark, keys):
        spark.createDataFrame([], schemas.RAW_DAYS).write.mode("ignore").parquet(keys)
    wanted = drop_deleted(batch)
    dated = with_event_date(wanted, PARTITION_TIME["raw_messages"])
    ids = wanted.select("message_id").where("message_id is not null").distinct()
    held = spark.read.schema(schemas.RAW_DAYS).parquet(keys).join(ids, "message_id", "left_semi").select(PARTITION)
    days = cut_lineage(held.unionByName(dated.select(PARTITION)).distinct())
    schema = f"{schemas.RAW_MESSAGES}, {PARTITION} date"
    stored = spark.read.schema(schema).parquet(table)
    old = stored.where(in_days([r[0] for r in days.collect()])).drop(PARTITION)
    # Rows without message_id are added; those of a batch that runs again are known by document.
    again = old.where("message_id is null").select("document_id").distinct()
    wanted = wanted.where("message_id is not null").unionByName(
        wanted.where("message_id is null").join(again, "document_id", "left_anti").select(*wanted.columns)
    )
    counts = affected_rows(old, wanted).head()
    merged = written(raw_upsert(old, wanted, ROW if ROW in batch.columns else None), "merged")
    if scratch is not None:
        drop_written(scratch)
    moved = with_event_date(merged, PARTITION_TIME["raw_messages"])
    partition_and_cluster(merged, table, PARTITION_TIME["raw_messages"], mode="overwrite")
    # A message whose time changed leaves its old folder; that may be empty now.
    left = days.join(moved.select(PARTITION).distinct(), PARTITION, "left_anti").where("event_date is not null")
    for row in left.collect():
        _drop_folder(spark, f"{table}/{PARTITION}={row[0]}")
    fresh = moved.select("message_id", PARTITION).where("message_id is not null").distinct()
    known = spark.read.schema(schemas.RAW_DAYS).parquet(keys)
    fresh.join(known, ["message_id", PARTITION], "left_anti").write.mode("append").parquet(keys)
    drop_written(merged)
    return counts


def waiting(spark: SparkSession, root: str, staged: DataFrame) -> DataFrame:
    """Staged documents that no ingest has processed."""
    done = f"{root}/staging_done"
    if not table_exists(spark, done):
        return staged
    return staging_ack(staged, spark.read.schema("document_id string").parquet(done))


def _drop_folder(spark: SparkSession, path: str) -> None:
    """Leave a folder of a table without rows."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(java, True)


def ensure_listing_table(spark: SparkSession, path: str, sources: dict[str, str]) -> bool:
    """Fill the listing table if it is missing. True if it was there already."""
    if table_exists(spark, path):
        return True
    listing_scan(spark, sources).write.parquet(path)
    return False


def load_listing(spark: SparkSession, path: str, sources: dict[str, str]) -> DataFrame:
    """Distinct listed symbols; fails if there are none."""
    ensure_listing_table(spark, path, sources)
    return require_rows(listing_symbols(spark.read.parquet(path)))


def as_json_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks without nested types."""

    def flat(name: str, kind: str) -> Column:
        nested = kind.startswith(("array", "map", "struct"))
        return json_text(F.col(name)).alias(name) if nested else F.col(name)

    return df.select(*[flat(n, k) for n, k in df.dtypes])


def export_relational(df: DataFrame, target: str | dict[str, str], mode: str = "append") -> None:
    """Write to a relational table (JDBC options) or, given a path, to Parquet."""
    flat = as_json_columns(with_etl_timestamp(df))
    if isinstance(target, dict):
        flat.write.format("jdbc").options(**target).mode(mode).save()
    else:
        flat.write.mode(mode).parquet(target)
