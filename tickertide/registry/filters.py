"""Filters, projections, deduplication, value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions import scoring as S
from tickertide.functions import text as X
from tickertide.functions import values as T
from tickertide.operators import clean as C
from tickertide.operators import dedup as D
from tickertide.operators import threads
from tickertide.operators.universe import is_ticker
from tickertide.registry import derived
from tickertide.registry.base import by_id, clean, deduped, listing_frame, query, raw
from tickertide.registry.scans import STAGED, staged_path
from tickertide.registry.sql import PERCENT, VALID, confidence, price_expr, select, signals
from tickertide.sources.messages import scan_staging

KEY = ("document_id", "message_id")


def _raw_ids(condition: str) -> str:
    return select(f"select document_id, message_id from raw where {condition}", "raw")


@query("valid_content", _raw_ids(VALID))
def _valid_content(spark, sf):
    return C.valid_content(raw(spark, sf)).select(*KEY)


@query("drop_deleted", _raw_ids("content is distinct from '[deleted]'"))
def _drop_deleted(spark, sf):
    return C.drop_deleted(raw(spark, sf)).select(*KEY)


@query("deleted_only", _raw_ids("content = '[deleted]'"))
def _deleted_only(spark, sf):
    return C.deleted_only(raw(spark, sf)).select(*KEY)


_LAST = "2024-01-20 10:00:00"


@query("since_watermark", _raw_ids(f"created_at > timestamp '{_LAST}'"))
def _since_watermark(spark, sf):
    return C.since_watermark(raw(spark, sf), F.lit(f"{_LAST}.9")).select(*KEY)


@query("hours_back", _raw_ids(f"created_at > timestamp '{_LAST}' - interval 36 hour"))
def _hours_back(spark, sf):
    return C.hours_back(raw(spark, sf), 36, F.lit(_LAST)).select(*KEY)


@query("late_rows", _raw_ids(
    f"ingestion_timestamp > timestamp '{_LAST}' and not created_at > timestamp '{_LAST}'"))
def _late_rows(spark, sf):
    """Rows that a watermark on creation time loses and one on arrival keeps."""
    arrived = C.since_watermark(raw(spark, sf), F.lit(_LAST), "ingestion_timestamp")
    return arrived.where(~(F.col("created_at") > F.lit(_LAST))).select(*KEY)


@query("normalize_message", select(
    """select document_id, message_id, content, author, cast("timestamp" as varchar) as "timestamp",
      cast(created_at as varchar) as created_at, score, message_type, coalesce(source, 'reddit') as source,
      title, num_comments, subreddit, parent_id, 1 as stamped from raw""", "raw"))
def _normalize_message(spark, sf):
    staged = scan_staging(spark, staged_path(spark, sf), STAGED, limit=None)
    rows = C.normalize_message(staged)
    return rows.select(
        *KEY, "content", "author", "timestamp", "created_at", "score", "message_type", "source",
        "title", "num_comments", "subreddit", "parent_id",
        F.col("ingestion_timestamp").isNotNull().cast("int").alias("stamped"),
    )


@query("deleted_author_default", select(
    "select document_id, coalesce(author, '[deleted]') as author from raw", "raw"))
def _deleted_author_default(spark, sf):
    return C.deleted_author_default(raw(spark, sf)).select("document_id", "author")


@query("full_text", select("select message_id, text from texts", "texts"))
def _full_text(spark, sf):
    return C.with_full_text(clean(spark, sf)).select("message_id", "text")


@query("content_contains", _raw_ids("contains(lower(content), 'merger')"))
def _content_contains(spark, sf):
    return C.content_contains(raw(spark, sf), "Merger").select(*KEY)


@query("created_hour", select(
    "select cast(hour(created_at) as int) as created_hour, count(*) as n from raw group by 1", "raw"))
def _created_hour(spark, sf):
    return C.created_hour(raw(spark, sf)).groupBy("created_hour").agg(F.count("*").alias("n"))




@query("regex_count", select(
    "select count(*) as n from raw where regexp_matches(message_id, '^m[0-9]*5$')", "raw"))
def _regex_count(spark, sf):
    return C.regex_count(raw(spark, sf), "message_id", "^m[0-9]*5$")


@query("comments_count", select(
    """select document_id, case when message_type = 'CNBC_ARTICLE' then 0 else num_comments end as comments_count
    from (select document_id, num_comments, case when score > 60 then 'CNBC_ARTICLE' else message_type end
      as message_type from raw)""", "raw"))
def _comments_count(spark, sf):
    kind = F.when(F.col("score") > 60, V.ARTICLE).otherwise(F.col("message_type"))
    return C.comments_count(raw(spark, sf).withColumn("message_type", kind)).select(
        "document_id", "comments_count"
    )


@query("posts_by_activity", _raw_ids(
    "message_type = 'REDDIT_POST' and num_comments between 5 and 20"))
def _posts_by_activity(spark, sf):
    return C.posts_by_activity(raw(spark, sf), 5, 20).select(*KEY)


@query("feed_sort", select(
    """select * from (select 'new' as mode, message_id from deduped where message_type = 'REDDIT_POST'
      order by created_at desc, message_id limit 100)
    union all select * from (select 'top', message_id from deduped where message_type = 'REDDIT_POST'
      and created_at >= timestamp '2024-01-20' order by score desc, created_at desc, message_id limit 100)""",
    "deduped"))
def _feed_sort(spark, sf):
    rows = deduped(spark, sf)
    newest = C.feed(rows, "new").limit(100).select(F.lit("new").alias("mode"), "message_id")
    top = C.feed(rows, "top", F.lit("2024-01-20").cast("timestamp")).limit(100)
    return newest.unionByName(top.select(F.lit("top").alias("mode"), "message_id"))


@query("score_rank", select(
    "select message_id, score from deduped order by score desc, message_id", "deduped"))
def _score_rank(spark, sf):
    rows = deduped(spark, sf).select("message_id", "score")
    return rows.orderBy(F.desc("score"), "message_id")


@query("forum_union", select(
    """select message_id, subreddit from deduped where message_type = 'REDDIT_POST'
    and subreddit in ('wallstreetbets', 'stocks', 'investing', 'stockmarket', 'options')""", "deduped"))
def _forum_union(spark, sf):
    """Posts of the five forums. One filter reads the table once, five scans would not."""
    posts = deduped(spark, sf).where(F.col("message_type") == V.POST)
    return posts.where(F.col("subreddit").isin(list(V.FORUMS))).select("message_id", "subreddit")


@query("daily_thread_pick", select(
    """select message_id, title from (select * from deduped where message_type = 'REDDIT_POST'
      and subreddit = 'wallstreetbets' and contains(lower(title), 'daily discussion thread')
      order by created_at desc, message_id limit 1)
    union all select message_id, title from (select * from deduped where message_type = 'REDDIT_POST'
      and subreddit = 'wallstreetbets' and contains(lower(title), 'weekend discussion thread')
      order by created_at desc, message_id limit 1)""", "deduped"))
def _daily_thread_pick(spark, sf):
    rows = deduped(spark, sf)
    friday, sunday = (
        threads.daily_thread_pick(rows, F.lit(d)).select("message_id", "title")
        for d in ("2024-01-26", "2024-01-28")
    )
    return friday.unionByName(sunday)


@query("dedup_by_ingestion", select("select message_id, document_id, content from deduped", "deduped"))
def _dedup_by_ingestion(spark, sf):
    return D.dedup_by_ingestion(raw(spark, sf), **by_id(spark, sf)).select("message_id", "document_id", "content")


@query("dedup_by_event_time", select("select message_id, document_id, content from clean", "clean"))
def _dedup_by_event_time(spark, sf):
    return D.dedup_by_event_time(C.valid_content(raw(spark, sf)), **by_id(spark, sf)).select(
        "message_id", "document_id", "content"
    )


@query("dedup_join", select(
    """select n.message_id, n.n_words from (select message_id, cast(length(title) as int) as n_words from deduped
        where title is not null) n join (select * from (select *, row_number() over (partition by message_id
          order by ingestion_timestamp desc, event_id desc) as rn from raw) where rn = 1) d
      on n.message_id = d.message_id where d.score > 10""", "raw", "deduped"))
def _dedup_join(spark, sf):
    messages = raw(spark, sf).withColumnRenamed("ingestion_timestamp", "etl_timestamp")
    titled = deduped(spark, sf).where(F.col("title").isNotNull()).select(
        "message_id", F.length("title").alias("n_words")
    )
    return D.dedup_join(titled, messages, F.col("d.score") > 10)


@query("to_ts", select(
    f"""select document_id, cast(created_at as varchar) as from_number,
      case when event_id % 5 = 1 then null else cast(created_at as varchar) end as from_text from raw""", "raw"))
def _to_ts(spark, sf):
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = raw(spark, sf).select(
        "document_id",
        F.col("created_at").cast("double").alias("from_number"),
        F.when(F.col("event_id") % 5 == 1, F.concat(F.lit("on "), iso)).otherwise(iso).alias("from_text"),
    )
    return T.with_ts(rows, "from_number", "from_text")


@query("hour_start", select(
    "select document_id, cast(date_trunc('hour', created_at) as varchar) as hour_start from raw", "raw"))
def _hour_start(spark, sf):
    return C.with_hour_start(raw(spark, sf)).select("document_id", "hour_start")


@query("week_start", select(
    """select document_id, cast(cast(date_trunc('week', created_at) as timestamp) as varchar) as week_start,
      strftime(created_at, '%Y-%m-%d') as day from raw""", "raw"))
def _week_start(spark, sf):
    return raw(spark, sf).select(
        "document_id",
        T.week_start(F.col("created_at")).alias("week_start"),
        F.to_date("created_at").alias("day"),
    )


@query("day", select(
    "select strftime(created_at, '%Y-%m-%d') as day, count(*) as n from raw group by 1", "raw"))
def _day(spark, sf):
    return raw(spark, sf).groupBy(F.to_date("created_at").alias("day")).agg(F.count("*").alias("n"))


@query("format_times", select(
    """select document_id, strftime(created_at, '%Y-%m-%d') as day_text,
      strftime(created_at, '%Y-%m-%d %H:%M:%S') as ts_text,
      strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') as iso_text from raw""", "raw"))
def _format_times(spark, sf):
    created = F.col("created_at")
    return raw(spark, sf).select(
        "document_id",
        T.format_date(created).alias("day_text"),
        T.format_ts(created).alias("ts_text"),
        T.format_iso(created).alias("iso_text"),
    )


@query("strip_zone", select(
    """select document_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as wall,
      cast(cast(date_trunc('day', created_at) as timestamp) as varchar) as midnight from raw""", "raw"))
def _strip_zone(spark, sf):
    zoned = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    return raw(spark, sf).select(
        "document_id",
        T.wall_clock(zoned).alias("wall"),
        T.strip_zone(F.to_date("created_at")).alias("midnight"),
    )


_JSON = "map<string,bigint>"


@query("safe_json_loads", """select event_id, case when event_id % 4 < 2 then
  cast(regexp_extract(props, '([0-9]+)', 1) as bigint) else -1 end as k from events""")
def _safe_json_loads(spark, sf):
    event = F.col("event_id")
    text = F.when(event % 4 < 2, F.col("props")).when(event % 4 == 2, F.lit("{not json"))
    default = F.create_map(F.lit("k"), F.lit(-1).cast("bigint"))
    return derived.table(spark, sf, "events").select(
        "event_id", T.json_or(text, _JSON, default)["k"].alias("k")
    )


@query("safe_json_dumps", """select event_id, case when event_id % 3 = 0 then '{}' else
  concat('{"day":"', strftime(ts, '%Y-%m-%d'), '","at":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
    '","type":"', event_type, '"}') end as body from events""")
def _safe_json_dumps(spark, sf):
    body = F.struct(
        F.to_date("ts").alias("day"), F.col("ts").alias("at"), F.col("event_type").alias("type")
    )
    return derived.table(spark, sf, "events").select(
        "event_id", T.json_text(F.when(F.col("event_id") % 3 != 0, body)).alias("body")
    )


@query("merge_json", """select event_id, concat('{"k": ',
  2 * cast(regexp_extract(props, '([0-9]+)', 1) as bigint), ', "tags": ["', event_type, '", "', event_type,
  '"], "who": {"', user_id, '": 2}, "name": "new"}') as merged from events""")
def _merge_json(spark, sf):
    head = F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(', "tags": ["'), F.col("event_type"),
                    F.lit('"], "who": {"'), F.col("user_id"), F.lit('": 1}, "name": "'))
    return derived.table(spark, sf, "events").select(
        "event_id",
        T.merge_json(F.concat(head, F.lit('old"}')), F.concat(head, F.lit('new"}'))).alias("merged"),
    )


@query("merge_counts", """select user_id, event_type as key, count(*) as n from events group by 1, 2""")
def _merge_counts(spark, sf):
    events = derived.table(spark, sf, "events")

    def counts(part):
        pairs = part.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
        return pairs.groupBy("user_id").agg(
            F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("counts")
        )

    early = counts(events.where(F.col("ts") < derived.BATCH_CUT)).alias("a")
    late = counts(events.where(F.col("ts") >= derived.BATCH_CUT)).alias("b")
    merged = early.join(late, "user_id", "full").select(
        "user_id", T.merge_counts(F.col("a.counts"), F.col("b.counts")).alias("counts")
    )
    return merged.select("user_id", F.explode("counts").alias("key", "n"))


@query("ticker_pattern", select(
    "select ticker, cast(regexp_full_match(ticker, '[A-Z]{1,5}') as int) as valid, count(*) as n "
    "from listed group by 1, 2", "listed"))
def _ticker_pattern(spark, sf):
    rows = listing_frame(spark, sf).withColumn("valid", is_ticker(F.col("ticker")).cast("int"))
    return rows.groupBy("ticker", "valid").agg(F.count("*").alias("n"))


@query("trim_texts", select(
    """select message_id, substr(text, 1, 512) as scorer_text, substr(text, 1, 200) as stored_text
    from texts""", "texts"))
def _trim_texts(spark, sf):
    rows = C.with_full_text(clean(spark, sf))
    return rows.select(
        "message_id",
        F.substring("text", 1, V.SHORT_TEXT.scorer_chars).alias("scorer_text"),
        F.substring("text", 1, V.SHORT_TEXT.stored_chars).alias("stored_text"),
    )


@query("extract_signals", select(
    f"select message_id, {signals('text')} as signals from texts", "texts"))
def _extract_signals(spark, sf):
    """Signals of the whole text of every message."""
    rows = C.with_full_text(clean(spark, sf))
    return rows.select("message_id", F.concat_ws(",", X.extract_signals(F.col("text"))).alias("signals"))


@query("price_and_change", select(
    f"""select message_id, cast(nullif(regexp_extract(text, '{PERCENT}', 1), '') as double) as change,
      {price_expr('text')} as target from texts""", "texts"))
def _price_and_change(spark, sf):
    rows = C.with_full_text(clean(spark, sf))
    return rows.select(
        "message_id",
        X.percent_change(F.col("text")).alias("change"),
        X.price_target(F.col("text")).alias("target"),
    )


@query("keyword_sentiment", select(
    """select document_id, case when lower(content) like '%bullish%' or lower(content) like '%buy%'
        or lower(content) like '%up%' then 1 when lower(content) like '%bearish%' or lower(content) like '%sell%'
        or lower(content) like '%down%' then -1 else 0 end as score from raw""", "raw"))
def _keyword_sentiment(spark, sf):
    return raw(spark, sf).select("document_id", X.keyword_sentiment(F.col("content")).alias("score"))


@query("confidence", select(
    f"""select document_id, {confidence('compound', 'score')} as confidence from (
      select document_id, score, cast(num_comments as double) / 37 as compound from raw)""", "raw"))
def _confidence(spark, sf):
    compound = F.col("num_comments").cast("double") / 37
    return raw(spark, sf).select("document_id", S.confidence(compound, F.col("score")).alias("confidence"))


@query("compound", select(
    """select document_id, cast(round(cast(cast(num_comments as double) / 37 - coalesce(neg, 0) as decimal(18,6)), 3)
      as double) as compound from (select document_id, num_comments,
        case when event_id % 4 <> 0 then cast(event_id % 41 as double) / 41 end as neg from raw)""", "raw"))
def _compound(spark, sf):
    event = F.col("event_id")
    negative = F.when(event % 4 != 0, (event % 41).cast("double") / 41)
    return raw(spark, sf).select(
        "document_id", S.compound(F.col("num_comments").cast("double") / 37, negative).alias("compound")
    )


@query("compound_from_top_label", select(
    """select document_id, cast(round(cast(case when p > n and p > 0 then p when n > 0 and n >= p then -n else 0.0 end
      as decimal(18,6)), 3) as double) as compound from (select document_id,
        cast(event_id % 17 as double) / 17 as p, cast(event_id % 19 as double) / 19 as n from raw)""", "raw"))
def _compound_from_top_label(spark, sf):
    event = F.col("event_id")

    def label(name, modulus):
        score = (event % modulus).cast("double") / modulus
        return F.struct(F.lit(name).alias("label"), score.alias("score"))

    labels = F.array(label("NEGATIVE", 19), label("POSITIVE", 17))
    return raw(spark, sf).select("document_id", S.compound_from_top_label(labels).alias("compound"))
