"""Sinks, upserts, joins on stored tables, threads, state and streams."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide import vocab as V
from tickertide.operators import analysis as A
from tickertide.operators import clean as C
from tickertide.operators import merge, summaries as G, threads
from tickertide.operators.dedup import dedup_by_event_time, dedup_by_ingestion
from tickertide.plans import run as R
from tickertide.plans.flow import scheduled
from tickertide.plans.state import RunState, ThreadState, current_watermarks
from tickertide.registry import derived, scans
from tickertide.registry.base import (
    by_id,
    deduped,
    listing_frame,
    mentions,
    query,
    raw,
    stored_mentions,
    universe,
)
from tickertide.registry.mention_queries import (
    ANALYSIS_SQL,
    PERIODS,
    SENTIMENT_SQL,
    flat_mentions,
    metric_columns,
    summary_sql,
)
from tickertide.registry.sql import select
from tickertide.session import cut_lineage, scratch_path
from tickertide.sources import prices as P
from tickertide.sources import tables
from tickertide.sources.snapshots import Conflict, Snapshots
from tickertide.streaming.dedup import dedup_stream
from tickertide.streaming.incremental import incremental
from tickertide.streaming.staging import ingest_stream, staged_stream
from tickertide.streaming.windows import compact_updates, window_totals, write_updates

CUT = derived.BATCH_CUT


# -- tables --


@query("mentions_append_new", select(
    "select message_id, ticker, sentiment_compound, signals, confidence from mentions", "mentions"))
def _mentions_append_new(spark, sf):
    """A second batch that repeats some stored days adds only what is new."""
    root = scratch_path(spark, "append")
    rows = stored_mentions(spark, sf)
    tables.create_tables(spark, root)
    tables.mentions_append_new(spark, root, rows.where(F.col("created_at") < CUT))
    overlap = rows.where(F.col("created_at") >= F.lit(CUT).cast("timestamp") - F.expr("interval 5 days"))
    tables.mentions_append_new(spark, root, overlap.unionByName(overlap))
    stored = tables.read_table(spark, root, "stock_mentions")
    return flat_mentions(stored).select(
        "message_id", "ticker", "sentiment_compound", "signals", "confidence"
    )


@query("mentions_append_copies", select(
    f"""select message_id, ticker, cast(case when created_at < timestamp '{CUT}' then created_at
      when ticker = 'AMD' then null else created_at + interval 3 day end as varchar) as created_at from mentions""",
    "mentions"))
def _mentions_append_copies(spark, sf):
    """Copies of messages on other days and without a time add nothing, however often."""
    root = scratch_path(spark, "copies")
    rows = stored_mentions(spark, sf)
    tables.create_tables(spark, root)
    tables.mentions_append_new(spark, root, rows.where(F.col("created_at") < CUT))
    later = F.when(F.col("ticker") != "AMD", F.col("created_at") + F.expr("interval 3 days"))
    copies = rows.withColumn("created_at", later)
    tables.mentions_append_new(spark, root, copies)
    tables.mentions_append_new(spark, root, copies)
    return tables.read_table(spark, root, "stock_mentions").select("message_id", "ticker", "created_at")


_PARTS_SQL = " union all ".join([
    *[f"""select '{g.name}' as grain, ticker, {PERIODS[g.name]} as period, 'mentions' as part, null as key,
        count(*) as n from mentions group by 2, 3""" for g in G.GRAINS.values()],
    *[f"""select '{g.name}', ticker, {PERIODS[g.name]}, 'subreddits', subreddit, count(*) from mentions
        where subreddit is not null group by 2, 3, 5""" for g in G.GRAINS.values()],
    *[f"""select '{g.name}', ticker, {PERIODS[g.name]}, 'price_targets', cast(cast(substr(tag, 4) as double) as varchar), count(*)
        from (select ticker, created_at, unnest(string_split(signals, ',')) as tag from mentions)
        where starts_with(tag, 'PT:') group by 2, 3, 5""" for g in (G.DAILY, G.WEEKLY)],
    f"""select 'weekly', ticker, {PERIODS['weekly']}, 'daily_breakdown', strftime(created_at, '%Y-%m-%d'), count(*)
        from mentions group by 2, 3, 5""",
    """select 'daily', ticker, strftime(created_at, '%Y-%m-%d'), 'context ' || rn, context, 1 from (
        select *, row_number() over (partition by ticker, cast(created_at as date)
          order by confidence desc, message_id, context) as rn from mentions) where rn <= 3""",
])


def summary_parts(spark, root):
    """Counts, maps and contexts of the three stored summaries as rows."""
    parts = []
    for g in G.GRAINS.values():
        rows = tables.read_table(spark, root, f"stock_{g.name}_summary").withColumn("period", F.col(g.period).cast("string"))
        at = [F.lit(g.name).alias("grain"), F.col("ticker"), F.col("period")]
        parts.append(rows.select(*at, F.lit("mentions").alias("part"), F.lit(None).cast("string").alias("key"), F.col("mention_count").alias("n")))
        parts += [rows.select(*at, F.lit(m).alias("part"), F.explode(m).alias("key", "n")) for m in g.maps]
        if g.contexts:
            found = rows.select(*at, F.posexplode("top_contexts").alias("i", "c"))
            parts.append(found.select("grain", "ticker", "period", F.concat(F.lit("context "), (F.col("i") + 1).cast("string")).alias("part"),
                                      F.col("c.context").alias("key"), F.lit(1).cast("bigint").alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query("accumulate_modes", select(_PARTS_SQL, "mentions"))
def _accumulate_modes(spark, sf):
    """Batches in alternating modes, one of them repeated, equal one run over everything."""
    root = scratch_path(spark, "modes")
    rows = stored_mentions(spark, sf)
    tables.create_tables(spark, root)
    day = F.dayofmonth("created_at")
    early, late = rows.where(day < 10), rows.where(day >= 20)
    R.save_batch(spark, root, early, "exact")
    R.save_batch(spark, root, rows.where(day.between(9, 19)), "accumulate")
    R.save_batch(spark, root, rows.where(day.between(9, 19)), "accumulate")
    R.save_batch(spark, root, late, "exact")
    R.save_batch(spark, root, rows, "accumulate")
    return summary_parts(spark, root)


INGEST_SQL = select(
    f"""select document_id, message_id, content, score, cast("timestamp" as varchar) as timestamp from (
      select s.document_id, s.message_id, case when l.message_id is null then s.content else l.content end as content,
        coalesce(l.score, s.score) as score, case when l.message_id is null then s."timestamp" else l."timestamp" end as "timestamp"
      from first_batch s left join latest l on s.message_id = l.message_id
      union all select document_id, message_id, content, score, "timestamp" from latest
        where message_id not in (select message_id from first_batch))""", "raw",
    more=f"""first_all as (select *, row_number() over (partition by message_id order by ingestion_timestamp desc,
        created_at desc, event_id desc) as rn from raw where created_at < timestamp '2024-01-20' and content is distinct from '[deleted]'),
      first_batch as (select * exclude (rn) from first_all where rn = 1),
      batch as (select * replace (score + 100 as score, 'x' || document_id as document_id,
        case when event_id % 3 = 0 then "timestamp" + interval 2 day else "timestamp" end as "timestamp") from raw
        where created_at >= timestamp '2024-01-18' and content is distinct from '[deleted]'),
      latest as (select * exclude (rn) from (select *, row_number() over (partition by message_id order by
        ingestion_timestamp desc, created_at desc, event_id desc) as rn from batch) where rn = 1)""")


@query("ingest_raw", INGEST_SQL)
def _ingest_raw(spark, sf):
    """Two staged batches, the second one twice; some messages move to another day."""
    root = scratch_path(spark, "ingest")
    first, second = staged_batches(spark, sf)
    for staged in (first, second, second):
        tables.ingest_raw(spark, root, staged)
    return spark.read.parquet(f"{root}/raw_messages").select("document_id", "message_id", "content", "score", "timestamp")


def staged_batches(spark, sf):
    """Messages of the first days, and of the others with another document, score and, for
    some, day."""
    rows = raw(spark, sf)
    first = rows.where("created_at < timestamp '2024-01-20'")
    later = F.when(F.col("event_id") % 3 == 0, F.col("timestamp") + F.expr("interval 2 days")).otherwise(F.col("timestamp"))
    second = rows.where("created_at >= timestamp '2024-01-18'").withColumns({
        "score": F.col("score") + 100, "document_id": F.concat(F.lit("x"), "document_id"), "timestamp": later,
    })
    return first, second


@query("ingest_stream", INGEST_SQL)
def _ingest_stream(spark, sf):
    """The same batches as JSON files that arrive in two goes; the stream is stopped between."""
    root, staging = scratch_path(spark, "ingest"), scratch_path(spark, "staging")
    progress, archive = scratch_path(spark, "progress"), scratch_path(spark, "archive")
    for batch in staged_batches(spark, sf):
        batch.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("compression", "gzip").mode("append").json(staging)
        stream = staged_stream(spark, staging, f"{schemas.RAW_MESSAGES}, event_id bigint", archive)
        _drain(ingest_stream(stream, root, progress))
    return spark.read.parquet(f"{root}/raw_messages").select("document_id", "message_id", "content", "score", "timestamp")


@query("ingest_waiting", select(
    "select document_id from raw where not created_at < timestamp '2024-01-20'", "raw"))
def _ingest_waiting(spark, sf):
    """What still waits after one batch of the staged documents was processed."""
    root = scratch_path(spark, "ingest")
    rows = raw(spark, sf)
    tables.ingest_raw(spark, root, rows.where(_STORED))
    return tables.waiting(spark, root, rows).select("document_id")


@query("create_tables", select(
    """select 'stock_mentions' as name, count(*) as n from mentions union all select unnest([
      'stock_daily_summary', 'stock_hourly_summary', 'stock_weekly_summary']), 0""", "mentions"))
def _create_tables(spark, sf):
    """New tables are readable at once; creating them again keeps what they hold."""
    root = scratch_path(spark, "tables")
    tables.create_tables(spark, root)
    tables.mentions_append_new(spark, root, stored_mentions(spark, sf))
    tables.create_tables(spark, root)
    sizes = [
        tables.read_table(spark, root, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in sorted(schemas.TABLES)
    ]
    return reduce(DataFrame.unionByName, sizes)


@query("summary_upsert", select(summary_sql(G.DAILY), "mentions"))
def _summary_upsert(spark, sf):
    """Two batches, the touched days recomputed and upserted, equal one full run."""
    root = scratch_path(spark, "upsert")
    tables.create_tables(spark, root)
    rows = stored_mentions(spark, sf)
    early = rows.where(F.col("created_at") < CUT)
    late = rows.where(F.col("created_at") >= CUT)
    name, keys = "stock_daily_summary", G.DAILY.keys
    tables.summary_upsert(spark, root, name, G.daily_summary(early), keys)
    touched = G.touched_periods(rows, late, G.DAILY)
    tables.summary_upsert(spark, root, name, G.daily_summary(touched), keys)
    return tables.read_table(spark, root, name).select(*metric_columns(G.DAILY))


@query("summary_commits", select(
    f"select *, 1 as refused from ({summary_sql(G.DAILY)})", "mentions"))
def _summary_commits(spark, sf):
    """Two writers start from one snapshot. The one that is late on the same days is refused
    and repeats its work; a change of other days goes on top."""
    root, rows, grain = scratch_path(spark, "commits"), stored_mentions(spark, sf), G.DAILY
    tables.create_tables(spark, root)
    tables.mentions_append_new(spark, root, rows)
    days = rows.select(F.to_date("created_at").alias("event_date")).distinct()
    early, late = days.where(F.dayofmonth("event_date") < 12), days.where(F.dayofmonth("event_date") >= 12)
    store = Snapshots(spark, root)
    base = store.current()
    mine, same, other = (tables.refreshed(spark, root, d, grain) for d in (early, early, late))
    store.commit(mine, base)
    store.commit(other, base)
    try:
        store.commit(same, base)
        refused = 0
    except Conflict:
        refused = 1
        tables.refresh_summary(spark, root, early, grain)
    stored = tables.read_table(spark, root, "stock_daily_summary").select(*metric_columns(grain))
    return stored.withColumn("refused", F.lit(refused))


@query("save_records", select("select document_id, score, 1 as stamped from raw", "raw"))
def _save_records(spark, sf):
    saved = tables.save_records(spark, raw(spark, sf).select("document_id", "score"))
    return saved.select(
        "document_id", "score", F.col("etl_timestamp").isNotNull().cast("int").alias("stamped")
    )


_STORED = "created_at < timestamp '2024-01-20'"
_BATCH = "created_at >= timestamp '2024-01-10'"
_BATCH_SQL = f"""select * replace (score + 100 as score, 'x' || document_id as document_id,
    'again' as submission_id) from raw where {_BATCH}"""
_LATEST_SQL = """select * exclude (rn) from (select *, row_number() over (partition by message_id
  order by ingestion_timestamp desc, created_at desc, event_id desc) as rn from batch) where rn = 1"""
_MERGE_PARTS = f"""stored as (select * from raw where {_STORED}), batch as ({_BATCH_SQL}),
  latest as ({_LATEST_SQL})"""


def _as_batch(rows):
    return rows.withColumns({
        "score": F.col("score") + 100,
        "document_id": F.concat(F.lit("x"), "document_id"),
        "submission_id": F.lit("again"),
    })


def _stored_and_batch(spark, sf):
    rows = raw(spark, sf)
    return rows.where(_STORED), _as_batch(rows.where(_BATCH))


_RAW_OUT = ("document_id", "message_id", "content", "author", "url", "score", "created_at",
            "title", "submission_id", "num_comments")


@query("raw_upsert", select(
    """select s.document_id, s.message_id, case when l.message_id is null then s.content else l.content end as content,
      case when l.message_id is null then s.author else l.author end as author, coalesce(l.url, s.url) as url,
      coalesce(l.score, s.score) as score, cast(coalesce(l.created_at, s.created_at) as varchar) as created_at,
      case when l.message_id is null then s.title else l.title end as title, s.submission_id,
      coalesce(l.num_comments, s.num_comments) as num_comments
    from stored s left join latest l on s.message_id = l.message_id
    union all select l.document_id, l.message_id, l.content, l.author, l.url, l.score, cast(l.created_at as varchar),
      l.title, l.submission_id, l.num_comments from latest l
    where not exists (select 1 from stored s where s.message_id = l.message_id)""", "raw", more=_MERGE_PARTS))
def _raw_upsert(spark, sf):
    known = by_id(spark, sf)
    merged = merge.raw_upsert(
        *_stored_and_batch(spark, sf), row_id=known["row_id"], fetch_stored=known["fetch"],
        fetch_batch=lambda ids: _as_batch(known["fetch"](ids)),
    )
    return merged.select(*_RAW_OUT)


@query("affected_rows", select(
    """select cast(coalesce(sum(case when c.n > 0 then c.n end), 0) as bigint) as updated,
      cast(count(*) filter (c.n is null) as bigint) as inserted
    from latest l left join (select message_id, count(*) as n from stored group by 1) c
      on l.message_id = c.message_id""", "raw", more=_MERGE_PARTS))
def _affected_rows(spark, sf):
    return merge.affected_rows(*_stored_and_batch(spark, sf))


@query("raw_append", select(
    """select document_id, message_id, score, coalesce(source, 'reddit') as source, cast(null as varchar) as title,
      cast(null as int) as depth from raw""", "raw"))
def _raw_append(spark, sf):
    """Documents with a few fields; the others become null and the source its default."""
    path = scratch_path(spark, "raw")
    rows = raw(spark, sf).select("document_id", F.col("message_id").alias("id"), "score", "source", "created_at")
    for part in (rows.where(F.col("created_at") < CUT), rows.where(F.col("created_at") >= CUT)):
        tables.append(C.normalize_message(part), path)
    stored = spark.read.schema(schemas.RAW_MESSAGES).parquet(path)
    return stored.select("document_id", "message_id", "score", "source", "title", "depth")


@query("field_merge_upsert", select(
    f"""select coalesce(n.message_id, o.message_id) as message_id, coalesce(n.title, o.title) as title,
      coalesce(n.author, o.author) as author, o.url, n.score, o.event_id as event_id from
      (select * from raw where {_STORED}) o full join
      (select message_id, arg_max(score, event_id) as score, arg_max(author, event_id) filter (author is not null) as author,
        arg_max(upper(title), event_id) filter (score > 20 and title is not null) as title
        from raw where {_BATCH} and event_id % 11 <> 0 group by 1) n on o.message_id = n.message_id
    union all select null, case when score > 20 then upper(title) end, author, null, score, null from raw
      where {_BATCH} and event_id % 11 = 0""", "raw"))
def _field_merge_upsert(spark, sf):
    """The batch repeats keys, and some of its rows have none."""
    rows = raw(spark, sf)
    stored = rows.where(_STORED).select("message_id", "title", "author", "url", F.col("event_id").alias("stored_id"))
    batch = rows.where(_BATCH).select(
        F.when(F.col("event_id") % 11 != 0, F.col("message_id")).alias("message_id"), "score",
        F.when(F.col("score") > 20, F.upper("title")).alias("title"), "author", "event_id",
    )
    merged = merge.field_merge_upsert(stored, batch, "message_id", latest=["event_id"])
    return merged.select("message_id", "title", "author", "url", "score", F.col("stored_id").alias("event_id"))


@query("staging_ack", select(
    "select document_id from raw where not created_at < timestamp '2024-01-20'", "raw"))
def _staging_ack(spark, sf):
    staged = raw(spark, sf).select("document_id", "created_at")
    return merge.staging_ack(staged, staged.where(_STORED)).select("document_id")


@query("overwrite_prices", select("select count(*) as n_rows, count(distinct ticker) as tickers from ohlcv", "ohlcv"))
def _overwrite_prices(spark, sf):
    path = scratch_path(spark, "prices")
    prices = P.price_cast(scans.price_rows(spark, sf))
    tables.overwrite(prices.where("Volume > 100000"), path)
    tables.overwrite(prices, path)
    return P.price_totals(spark.read.parquet(path)).select("n_rows", "tickers")


@query("overwrite_query", select(SENTIMENT_SQL, "deduped"))
def _overwrite_query(spark, sf):
    path = scratch_path(spark, "sentiment")
    tables.overwrite(A.sentiment_by_subreddit(deduped(spark, sf)), path)
    return spark.read.parquet(path).drop("analysis_timestamp")


@query("export_sentiment", select(SENTIMENT_SQL, "deduped"))
def _export_sentiment(spark, sf):
    path = scratch_path(spark, "export")
    tables.export_relational(A.sentiment_by_subreddit(deduped(spark, sf)), path)
    return spark.read.parquet(path).drop("analysis_timestamp", "etl_timestamp")


@query("append_summary_row", select(
    f"{ANALYSIS_SQL} union all select * from ({ANALYSIS_SQL.replace('from raw', 'from early')})",
    "raw", more=f"early as (select * from raw where created_at < timestamp '{CUT}')"))
def _append_summary_row(spark, sf):
    path = scratch_path(spark, "analysis")
    rows = raw(spark, sf)
    tables.append(A.analysis_summary(rows.where(F.col("created_at") < CUT)), path)
    tables.append(A.analysis_summary(rows), path)
    return spark.read.parquet(path).drop("analysis_date")


@query("partition_and_cluster", select(
    """select strftime("timestamp", '%Y-%m-%d') as event_date, subreddit, message_type, count(*) as n from raw
    group by 1, 2, 3""", "raw"))
def _partition_and_cluster(spark, sf):
    """Write by day and count by the partition and cluster columns."""
    path = scratch_path(spark, "messages")
    tables.partition_and_cluster(raw(spark, sf), path)
    return spark.read.parquet(path).groupBy("event_date", "subreddit", "message_type").agg(F.count("*").alias("n"))


@query("listing_insert", select("select ticker, exchange, company_name from listed", "listed"))
def _listing_insert(spark, sf):
    path = scratch_path(spark, "tickers")
    rows = listing_frame(spark, sf)
    for exchange in V.LISTING_SYMBOL_COLUMN:
        tables.append(rows.where(F.col("exchange") == exchange), path)
    return spark.read.parquet(path).drop("last_updated")


@query("ensure_listing_table", select(
    "select distinct ticker from listed where regexp_full_match(ticker, '[A-Z]{1,5}')", "listed"))
def _ensure_listing_table(spark, sf):
    path, files = scratch_path(spark, "tickers"), scans.listing_files(spark, sf)
    return tables.load_listing(spark, path, files)


@query("backup_truncate_reload", select(
    """select 'messages' as name, message_id, count(*) as n from deduped group by 2
    union all select 'backup', message_id, count(*) from raw group by 2""", "raw", "deduped"))
def _backup_truncate_reload(spark, sf):
    root = scratch_path(spark, "messages")
    tables.write_version(raw(spark, sf), root)
    reloaded, backup = tables.backup_truncate_reload(
        spark, root, lambda df: dedup_by_ingestion(df, row_id="event_id"))

    def counts(name, df):
        return df.groupBy("message_id").agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), "message_id", "n"
        )

    return counts("messages", reloaded).unionByName(counts("backup", backup))


@query("temp_result_table", select("select count(*) as n from mentions", "mentions"))
def _temp_result_table(spark, sf):
    path = scratch_path(spark, "result")
    tables.temp_result_table(mentions(spark, sf), path)
    return spark.read.parquet(path).agg(F.count("*").alias("n"))


@query("create_like", select("select count(*) as rows_of_source, 0 as rows, 1 as same_schema from raw", "raw"))
def _create_like(spark, sf):
    """A frame without rows and with the columns of the messages."""
    rows = raw(spark, sf)
    empty = tables.create_like(rows)
    same = int(empty.schema == rows.schema)
    return rows.agg(F.count("*").alias("rows_of_source")).select(
        "rows_of_source", F.lit(empty.count()).cast("int").alias("rows"), F.lit(same).alias("same_schema")
    )


@query("merge_staged", select(
    """select message_id, count(*) as n, max(score) as score from (
      select message_id, score from stored where message_id not in (select message_id from latest)
      union all select s.message_id, l.score from stored s join latest l on s.message_id = l.message_id
      union all select message_id, score from latest where message_id not in (select message_id from stored))
    group by 1""", "raw", more=_MERGE_PARTS.replace(
        f"from raw where {_BATCH}", f"from raw where {_BATCH} and content is distinct from '[deleted]'")))
def _merge_staged(spark, sf):
    """Staged documents without the deleted ones, merged into the messages."""
    merged, _ = tables.merge_staged(*_stored_and_batch(spark, sf))
    return merged.groupBy("message_id").agg(F.count("*").alias("n"), F.max("score").alias("score"))


# -- joins on stored mentions --


@query("existing_mentions", select(
    "select message_id, ticker from mentions where created_at >= timestamp '2024-01-10' "
    "and created_at < timestamp '2024-01-20'", "mentions"))
def _existing_mentions(spark, sf):
    rows = stored_mentions(spark, sf)
    return merge.existing_rows(rows.where(_BATCH), rows.where(_STORED), ["message_id", "ticker"]).select(
        "message_id", "ticker"
    )


@query("new_mentions", select(
    "select message_id, ticker from mentions where created_at >= timestamp '2024-01-20'", "mentions"))
def _new_mentions(spark, sf):
    rows = stored_mentions(spark, sf)
    return merge.new_rows(rows.where(_BATCH), rows.where(_STORED), ["message_id", "ticker"]).select(
        "message_id", "ticker"
    )


def stored_root(spark, sf):
    """Tables with all mentions."""
    root = scratch_path(spark, "stored")
    tables.create_tables(spark, root)
    tables.mentions_append_new(spark, root, stored_mentions(spark, sf))
    return root


@query("mention_exists", select(
    """select t as ticker, cast(exists (select 1 from mentions m where m.ticker = t and m.message_id = 'm' || k) as int) as found
    from (select unnest(['AAPL', 'TSLA', 'AMD']) as t), (select unnest([7, 40]) as k)""", "mentions"))
def _mention_exists(spark, sf):
    """Some keys, asked at once."""
    keys = spark.range(1).select(F.explode(F.array(*map(F.lit, ("AAPL", "TSLA", "AMD")))).alias("ticker")).crossJoin(
        spark.range(1).select(F.explode(F.array(F.lit("m7"), F.lit("m40"))).alias("message_id")))
    return tables.mentions_exist(spark, stored_root(spark, sf), keys).select("ticker", F.col("found").cast("int").alias("found"))


@query("mention_exists_all", select(
    """select m.message_id, m.ticker, exists (select 1 from mentions x where x.ticker = m.ticker and x.message_id = m.message_id) as found
    from (select message_id, ticker from mentions union all select 'x' || message_id, ticker from mentions
      union all select message_id, ticker || '.' from mentions) as m""", "mentions"))
def _mention_exists_all(spark, sf):
    """The keys of all mentions, and as many that are not stored, asked of the key index."""
    rows = stored_mentions(spark, sf).select("message_id", "ticker")
    keys = rows.unionByName(rows.withColumn("message_id", F.concat(F.lit("x"), "message_id")))
    keys = keys.unionByName(rows.withColumn("ticker", F.concat("ticker", F.lit("."))))
    return tables.mentions_exist(spark, stored_root(spark, sf), keys)


@query("point_lookup", select(
    f"select * from ({summary_sql(G.HOURLY)}) where ticker = 'AAPL' and hour_start = '2024-01-15 12:00:00'",
    "mentions"))
def _point_lookup(spark, sf):
    hourly = G.hourly_summary(stored_mentions(spark, sf)).select(*metric_columns(G.HOURLY))
    key = {"ticker": "AAPL", "hour_start": datetime(2024, 1, 15, 12)}
    return merge.point_lookup(hourly, **key)


# -- threads --

THREADS_SQL = """threaded as (
  with recursive tree as (
    select c.message_id, c.parent_id, c.created_at, c."timestamp", 0 as depth, c.parent_id as thread_id,
      [struct_pack(a := c.created_at, b := c.message_id)] as path
    from comments c where c.parent_id is null or c.parent_id not in (select message_id from comments)
    union all
    select c.message_id, c.parent_id, c.created_at, c."timestamp", t.depth + 1, t.thread_id,
      list_append(t.path, struct_pack(a := c.created_at, b := c.message_id))
    from comments c join tree t on c.parent_id = t.message_id)
  select * from tree)"""
_COMMENTS = "comments as materialized (select * from deduped where message_type = 'REDDIT_COMMENT'), " + THREADS_SQL


@query("comment_depth", select(
    "select message_id, parent_id, depth, thread_id from threaded", "deduped", more=_COMMENTS))
def _comment_depth(spark, sf):
    return threads.comment_depth(deduped(spark, sf)).select(
        "message_id", "parent_id", "depth", "thread_id"
    )


@query("flatten_threads", select(
    """select thread_id, message_id, place from (select *, row_number() over (
      partition by thread_id order by path) as place from threaded) where place <= 5""", "deduped", more=_COMMENTS))
def _flatten_threads(spark, sf):
    """The first five comments of every thread, depth first."""
    rows = threads.flatten_threads(deduped(spark, sf), limit=5)
    return rows.select("thread_id", "message_id", F.col("place").cast("bigint").alias("place"))


@query("comments_per_depth", select(
    "select depth, count(*) as comments from threaded group by 1", "deduped", more=_COMMENTS))
def _comments_per_depth(spark, sf):
    return A.comments_per_depth(threads.comment_depth(deduped(spark, sf)))


@query("comment_time_range", select(
    """select thread_id, cast(min(created_at) as varchar) as oldest, cast(max(created_at) as varchar) as newest
    from threaded group by 1""", "deduped", more=_COMMENTS))
def _comment_time_range(spark, sf):
    return A.comment_time_range(threads.comment_depth(deduped(spark, sf)))


_CHECKED = """known as (select thread_id, max(created_at) - interval 3 day as last_check from threaded
  where thread_id is not null group by 1 order by max(created_at) desc, thread_id limit 1)"""


@query("new_thread_comments", select(
    """select message_id, thread_id from threaded where thread_id is distinct from (select thread_id from known)
      or created_at > (select last_check from known)""", "deduped", more=f"{_COMMENTS}, {_CHECKED}"))
def _new_thread_comments(spark, sf):
    """The thread with the newest comment is stored as checked three days before it."""
    rows = threads.comment_depth(deduped(spark, sf)).withColumn("timestamp", F.col("created_at"))
    known = (
        rows.where(F.col("thread_id").isNotNull())
        .groupBy("thread_id")
        .agg(F.max("created_at").alias("newest"))
        .orderBy(F.desc("newest"), "thread_id")
        .limit(1)
    )
    state = ThreadState(spark, scratch_path(spark, "threads"))
    state.save("an earlier one", datetime(2023, 12, 1, tzinfo=timezone.utc))
    row = known.head()
    state.save(row.thread_id, (row.newest - timedelta(days=3)).replace(tzinfo=timezone.utc))
    last_id, last_check = state.last()
    return threads.new_thread_comments(rows, F.lit(last_id), F.lit(last_check)).select("message_id", "thread_id")


_LIMIT, _PER_FORUM, _PER_POST = 5000, 1000, 3
_FORUM_ORDER = "list_position(['wallstreetbets', 'stocks', 'investing', 'stockmarket', 'options'], subreddit)"


@query("thread_limit", select(
    f"""select thread_id, message_id, place from (
      select message_id as thread_id, message_id, 0 as place from posts union all
      select t.thread_id, t.message_id, t.place from taken t join quota q on t.thread_id = q.message_id
      where q.taken_before + t.place <= {_LIMIT} - (select count(*) from posts))""", "deduped",
    more=f"""{_COMMENTS}, posts as materialized (select message_id, subreddit, created_at from (select *, row_number() over (
        partition by subreddit order by created_at desc, message_id) as rn from deduped
        where message_type = 'REDDIT_POST') where rn <= {_PER_FORUM}),
      taken as (select * from (select thread_id, message_id, row_number() over (partition by thread_id order by path) as place
        from threaded where thread_id in (select message_id from posts)) where place <= {_PER_POST}),
      quota as (select message_id, coalesce(sum(given) over (order by {_FORUM_ORDER}, created_at desc, message_id
          rows between unbounded preceding and 1 preceding), 0) as taken_before
        from (select p.*, (select count(*) from taken t where t.thread_id = p.message_id) as given from posts p))"""))
def _thread_limit(spark, sf):
    return threads.thread_limit(
        deduped(spark, sf), _LIMIT, posts_per_forum=_PER_FORUM, comments_per_post=_PER_POST
    )


@query("thread_limit_discussion", select(
    """select thread_id, message_id, place from (select message_id as thread_id, message_id, 0 as place from newest union all
      select message_id, message_id, 0 from daily union all
      select thread_id, message_id, row_number() over (partition by thread_id order by path) from threaded
        where thread_id in (select message_id from daily))""", "deduped",
    more=f"""{_COMMENTS}, newest as materialized (select message_id from deduped where message_type = 'REDDIT_POST'
        and subreddit = 'options' qualify row_number() over (order by created_at desc, message_id) = 1),
      daily as materialized (select message_id from deduped where message_type = 'REDDIT_POST'
        and subreddit = 'wallstreetbets' and contains(lower(title), 'daily discussion thread')
        order by created_at desc, message_id limit 1)"""))
def _thread_limit_discussion(spark, sf):
    """One post without comments, then the whole discussion thread of a Friday."""
    rows = deduped(spark, sf)
    pick = threads.daily_thread_pick(rows, datetime(2024, 1, 5))
    return threads.thread_limit(
        rows, 1_000_000, forums=("options",), posts_per_forum=1, comments_per_post=0, discussion=pick
    )


# -- state and whole runs --

_LOG_SQL = f"""log as (select case {' '.join(f"when event_id % 10 = {i} then '{s}'" for i, s in enumerate(V.STEPS))}
  else 'run' end as step, created_at as last_run, ingestion_timestamp as updated_at from raw)"""


def run_log(spark, sf):
    """Every event as the end of one of the steps."""
    number = F.col("event_id") % 10
    step = F.lit("run")
    for i, name in enumerate(V.STEPS):
        step = F.when(number == i, name).otherwise(step)
    return raw(spark, sf).select(
        step.alias("step"), F.col("created_at").alias("last_run"),
        F.col("ingestion_timestamp").alias("updated_at"),
    )


_WATERMARKS = "select step, cast(max(last_run) as varchar) as last_run from log group by 1"


@query("all_watermarks", select(_WATERMARKS, "raw", more=_LOG_SQL))
def _all_watermarks(spark, sf):
    return current_watermarks(run_log(spark, sf)).select("step", "last_run")


def _stored_state(spark, sf):
    path = scratch_path(spark, "state")
    run_log(spark, sf).write.parquet(path)
    return RunState(spark, path)


def _moment(spark, step, moment):
    rows = [(step, moment.strftime("%Y-%m-%d %H:%M:%S.%f").rstrip("0").rstrip("."))] if moment else []
    return spark.createDataFrame(rows, "step string, last_run string")


@query("step_watermark", select(f"select * from ({_WATERMARKS}) where step = 'daily_aggregation'", "raw", more=_LOG_SQL))
def _step_watermark(spark, sf):
    step = "daily_aggregation"
    return _moment(spark, step, _stored_state(spark, sf).step_watermark(step))


@query("run_watermark", select(f"select * from ({_WATERMARKS}) where step = 'run'", "raw", more=_LOG_SQL))
def _run_watermark(spark, sf):
    return _moment(spark, "run", _stored_state(spark, sf).run_watermark())


@query("advance_watermark", select(
    f"select step, case when step = 'analysis' then '2024-03-01 00:00:00' else last_run end as last_run "
    f"from ({_WATERMARKS})", "raw", more=_LOG_SQL))
def _advance_watermark(spark, sf):
    path = scratch_path(spark, "state")
    run_log(spark, sf).write.parquet(path)
    state = RunState(spark, path)
    state.advance("analysis", moment=datetime(2024, 3, 1, tzinfo=timezone.utc))
    return state.all_watermarks().select("step", "last_run")


@query("reset_state", select(
    "select count(distinct step) as steps, 0 as after_reset from log", "raw", more=_LOG_SQL))
def _reset_state(spark, sf):
    path = scratch_path(spark, "state")
    run_log(spark, sf).write.parquet(path)
    state = RunState(spark, path)
    steps = state.all_watermarks().agg(F.count("*").alias("steps"))
    before = cut_lineage(steps)
    state.reset()
    return before.crossJoin(state.all_watermarks().agg(F.count("*").cast("int").alias("after_reset")))


@query("stage_switches", select(
    """select count(*) as messages, (select count(*) from mentions) as mentions, 'success' as status
    from clean where created_at > timestamp '2024-01-31' - interval 720 hour""", "clean", "mentions"))
def _stage_switches(spark, sf):
    """Extract and analyze 30 days without storing anything."""
    return R.run(
        spark, scratch_path(spark, "run"), raw(spark, sf), universe(spark, sf),
        stages=("extract", "analyze"), hours_back=24 * 30,
        now=datetime(2024, 1, 31, tzinfo=timezone.utc), **by_id(spark, sf),
    )


@query("run_report", select(
    f"""select (select count(*) from clean) as messages, (select count(*) from mentions) as mentions,
      (select count(*) from ({summary_sql(G.HOURLY)})) as hourly, (select count(*) from ({summary_sql(G.DAILY)})) as daily,
      (select count(*) from ({summary_sql(G.WEEKLY)})) as weekly, 'success' as status""", "clean", "mentions"))
def _run_report(spark, sf):
    """All stages over all messages."""
    return R.run(spark, scratch_path(spark, "run"), raw(spark, sf), universe(spark, sf), **by_id(spark, sf))


# -- streams --


def file_stream(df, files_per_batch=1000):
    """The rows written to files and read back as a stream."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream")
    df.write.parquet(path)
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(spark.read.parquet(path).schema).parquet(path)


def _drain(writer):
    started = writer.trigger(availableNow=True).start()
    started.awaitTermination()


@query("stateful_dedup", select("select distinct message_id from clean", "clean"))
def _stateful_dedup(spark, sf):
    out = scratch_path(spark, "out")
    unique = dedup_stream(file_stream(raw(spark, sf)), "40 days").select("message_id", "document_id")
    _drain(
        unique.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "progress")).outputMode("append")
    )
    return spark.read.parquet(out).select("message_id")


def window_metrics(totals, grain):
    return G.means(totals, grain).select(*metric_columns(grain))


def _add_windows(grain):
    @query(f"tumbling_{grain.name}", select(summary_sql(grain), "mentions"))
    def _tumbling(spark, sf):
        return window_metrics(window_totals(stored_mentions(spark, sf), grain), grain)

    @query(f"tumbling_{grain.name}_stream", select(summary_sql(grain), "mentions"))
    def _tumbling_stream(spark, sf):
        """The same windows over a stream of several batches, in update mode, with rows of
        one window in different batches."""
        out = scratch_path(spark, "totals")
        stream = file_stream(stored_mentions(spark, sf).repartition("message_id"), files_per_batch=2)
        totals = window_totals(stream, grain, "40 days")
        _drain(
            totals.writeStream.foreachBatch(write_updates(out)).outputMode("update")
            .option("checkpointLocation", scratch_path(spark, "progress"))
        )
        latest = compact_updates(spark, out, scratch_path(spark, "compact"), grain.keys)
        return window_metrics(latest, grain)


for _grain in G.GRAINS.values():
    _add_windows(_grain)


@query("tumbling_hour_day_week", select(
    " union all ".join(
        f"select '{g.name}' as grain, ticker, cast(date_trunc('{unit}', created_at) as timestamp)::varchar as start, "
        "count(*) as n from mentions group by 2, 3"
        for g, unit in ((G.HOURLY, "hour"), (G.DAILY, "day"), (G.WEEKLY, "week"))), "mentions"))
def _tumbling_hour_day_week(spark, sf):
    rows = stored_mentions(spark, sf)
    parts = [
        window_totals(rows, g).select(
            F.lit(g.name).alias("grain"), "ticker", F.col(g.period).alias("start"), F.col("mention_count").alias("n")
        )
        for g in G.GRAINS.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("incremental_stream", select(summary_sql(G.WEEKLY), "mentions"))
def _incremental_stream(spark, sf):
    """Messages as a stream of two batches, with the copies each holds. The second one has all
    messages again on other days, which add nothing: the weekly table equals a full run."""
    root, path = scratch_path(spark, "tables"), scratch_path(spark, "stream")
    tables.create_tables(spark, root)
    rows = raw(spark, sf)
    copies = rows.withColumn("created_at", F.col("created_at") + F.expr("interval 9 days"))
    progress = scratch_path(spark, "progress")
    for part in (rows, copies):
        part.write.mode("append").parquet(path)
        reader = spark.readStream.schema(rows.schema).parquet(path)
        _drain(incremental(reader, root, universe(spark, sf), progress, row_id="event_id"))
    return tables.read_table(spark, root, "stock_weekly_summary").select(*metric_columns(G.WEEKLY))



@query("scheduled_flow", select(
    f"""select subreddit, message_count, avg_sentiment, (select count(*) from raw) as before, (select count(*) from deduped) as messages,
      (select count(*) from mentions) as mentions from ({SENTIMENT_SQL})""", "raw", "deduped", "mentions"))
def _scheduled_flow(spark, sf):
    """All stages over the stored messages; what is exported, and the rows of the tables."""
    root, out = scratch_path(spark, "flow"), scratch_path(spark, "export")
    before = raw(spark, sf)
    tables.write_version(before, f"{root}/messages")
    scheduled(spark, root, universe(spark, sf), out, row_id="event_id")
    current = spark.read.parquet(tables.current_path(spark, f"{root}/messages"))
    counts = {
        "before": before, "messages": current, "mentions": tables.read_table(spark, root, "stock_mentions"),
    }
    exported = spark.read.parquet(out).select("subreddit", "message_count", "avg_sentiment")
    # One row of counts, beside each exported row.
    return reduce(DataFrame.crossJoin, [df.agg(F.count("*").alias(n)) for n, df in counts.items()], exported)
