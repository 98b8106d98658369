"""Mentions, summaries and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions import text as X
from tickertide.operators import analysis as A
from tickertide.operators import clean as C
from tickertide.operators import mentions as M
from tickertide.operators import merge, summaries as G
from tickertide.operators.universe import volume_universe
from tickertide.registry import derived
from tickertide.registry.base import clean, deduped, mentions, query, raw, stored_mentions, universe
from tickertide.registry.sql import context_parts, select
from tickertide.sources.tables import as_json_columns

MENTION_COLUMNS = (
    "message_id", "ticker", "author", "created_at", "subreddit", "url", "score", "message_type",
    "sentiment_compound", "sentiment_positive", "sentiment_negative", "sentiment_neutral",
    "signals", "context", "confidence",
)
MENTIONS_SQL = select(
    f"select {', '.join(MENTION_COLUMNS).replace('created_at', 'cast(created_at as varchar) as created_at')} "
    "from mentions", "mentions")
MENTIONS_SHORT_SQL = select(
    f"select {', '.join(MENTION_COLUMNS).replace('created_at', 'cast(created_at as varchar) as created_at')} "
    "from mentions_short", "mentions_short")


def flat_mentions(rows):
    return rows.select(*MENTION_COLUMNS).withColumn("signals", F.concat_ws(",", "signals"))


@query("find_mentions", MENTIONS_SQL)
def _find_mentions(spark, sf):
    return flat_mentions(mentions(spark, sf))


@query("find_mentions_short", MENTIONS_SHORT_SQL)
def _find_mentions_short(spark, sf):
    """With the limits on tickers, searched text, contexts and scored text."""
    rows = M.find_mentions(clean(spark, sf), universe(spark, sf), limits=V.SHORT_TEXT)
    return flat_mentions(rows)


@query("extract_tickers", select(
    """select message_id, string_agg(ticker, ',' order by pos) as tickers from (
      select h.*, row_number() over (partition by message_id order by pos) as rn from hits_short h)
    where rn <= 10 group by 1""", "hits_short"))
def _extract_tickers(spark, sf):
    """The first ten of the first 2000 characters."""
    short = V.SHORT_TEXT
    rows = M.with_tickers(
        C.with_full_text(clean(spark, sf)), universe(spark, sf), short.max_tickers, short.max_chars
    )
    return rows.select("message_id", F.concat_ws(",", "tickers").alias("tickers")).where("tickers <> ''")


_ALL_TICKERS = select(
    "select message_id, string_agg(ticker, ',' order by pos) as tickers from hits group by 1", "hits")


@query("extract_tickers_whole_text", _ALL_TICKERS)
def _extract_tickers_whole_text(spark, sf):
    rows = M.with_tickers(C.with_full_text(clean(spark, sf)), universe(spark, sf))
    return rows.select("message_id", F.concat_ws(",", "tickers").alias("tickers")).where("tickers <> ''")


@query("extract_tickers_large_universe", _ALL_TICKERS)
def _extract_tickers_large_universe(spark, sf):
    """The same by the way for a universe that is too large for a constant."""
    tickers = volume_universe(derived.ohlcv(spark, sf)).select("ticker")
    rows = M.with_tickers(C.with_full_text(clean(spark, sf)), tickers, inline=1)
    return rows.select("message_id", F.concat_ws(",", "tickers").alias("tickers")).where("tickers <> ''")


@query("universe_lookup", select("select message_id, ticker from hits", "hits"))
def _universe_lookup(spark, sf):
    """Candidate words joined with the universe."""
    rows = C.with_full_text(clean(spark, sf)).select("message_id", "text")
    tickers = volume_universe(derived.ohlcv(spark, sf)).select("ticker")
    return M.ticker_positions(rows, tickers).select("message_id", "ticker")


@query("distinct_mentions", select(
    "select message_id, count(*) as tickers from hits group by 1", "hits"))
def _distinct_mentions(spark, sf):
    rows = M.with_tickers(C.with_full_text(clean(spark, sf)), universe(spark, sf))
    return rows.select("message_id", F.size("tickers").cast("bigint").alias("tickers")).where("tickers > 0")


@query("ticker_context", select(
    "select message_id, ticker, found as context from contexts_short", "contexts_short"))
def _ticker_context(spark, sf):
    """Around the first three mentions of the first ten tickers."""
    short = V.SHORT_TEXT
    rows = M.with_tickers(
        C.with_full_text(clean(spark, sf)), universe(spark, sf), short.max_tickers, short.max_chars
    )
    pairs = rows.select("message_id", "text", F.explode_outer("tickers").alias("ticker"))
    context = X.ticker_context(F.col("text"), F.col("ticker"), matches=short.matches, head=short.head)
    return pairs.where(F.col("ticker").isNotNull()).select("message_id", "ticker", context.alias("context"))


_WORD_PAIRS = f"""pairs as materialized (select message_id || '/' || ticker as key, message_id, ticker, text from (
    select message_id, text, unnest(['AAPL', 'MSFT', 'the', 'en']) as ticker from texts)),
  windows as ({context_parts(150)})"""


@query("ticker_context_wide", select(
    """select p.message_id, p.ticker, case when length(text) <= 450 then text when windows is not null then windows
      when strpos(text, p.ticker) > 0 then text else '' end as context
    from pairs p left join windows w on p.key = w.key""", "texts", more=_WORD_PAIRS))
def _ticker_context_wide(spark, sf):
    """Around all mentions in a wider window, with frequent words in the place of tickers."""
    words = F.explode(F.array(*[F.lit(w) for w in ("AAPL", "MSFT", "the", "en")]))
    rows = C.with_full_text(clean(spark, sf)).select("message_id", "text", words.alias("ticker"))
    return rows.select(
        "message_id", "ticker", X.ticker_context(F.col("text"), F.col("ticker"), 150).alias("context")
    )


def _vowel_scorer(batches):
    """A scorer of a user: shares of the letters a and e among both."""
    for texts in batches:
        a, e = texts.str.count("a"), texts.str.count("e")
        total = (a + e).where(a + e > 0, 1)
        yield pd.DataFrame({"positive": a / total, "negative": e / total, "neutral": 0.0})


@query("text_scorer", select(
    """select message_id, ticker, cast(round(cast(coalesce((a - e) / nullif(a + e, 0), 0) as decimal(18,6)), 3) as double)
      as sentiment_compound from (select message_id, ticker,
        cast(length(t) - length(replace(t, 'a', '')) as double) as a,
        cast(length(t) - length(replace(t, 'e', '')) as double) as e
      from (select message_id, ticker, context as t from chosen))""", "chosen"))
def _text_scorer(spark, sf):
    rows = M.find_mentions(clean(spark, sf), universe(spark, sf), scorer=_vowel_scorer)
    return rows.select("message_id", "ticker", "sentiment_compound")


# -- summaries --

_SUM = {
    "s": "cast(sum(cast(sentiment_compound as decimal(18,6))) as double)",
    "c": "cast(sum(cast(confidence as decimal(18,6))) as double)",
    "sc": "cast(sum(cast(sentiment_compound * confidence as decimal(18,6))) as double)",
}
METRICS_SQL = f"""count(*) as mention_count, {_SUM['s']} / count(*) as avg_sentiment,
  case when {_SUM['c']} > 0 then {_SUM['sc']} / {_SUM['c']} else {_SUM['s']} / count(*) end as weighted_sentiment,
  {_SUM['c']} / count(*) as avg_confidence"""
HIGH_SQL = """cast(sum(cast(sentiment_compound as decimal(18,6))) filter (confidence > 0.7) as double)
  / nullif(count(*) filter (confidence > 0.7), 0) as high_conf_sentiment"""


def tags_sql(tags) -> str:
    return ", ".join(
        f"count(*) filter (list_contains(string_split(signals, ','), '{t}')) as {t.lower()}_signals"
        for t in tags
    )


PERIODS = {
    "hourly": "cast(date_trunc('hour', created_at) as varchar)",
    "daily": "strftime(created_at, '%Y-%m-%d')",
    "weekly": "cast(cast(date_trunc('week', created_at) as timestamp) as varchar)",
}


def summary_sql(grain: G.Grain, source: str = "mentions") -> str:
    extra = f", {HIGH_SQL}" if grain.high_conf else ""
    return (
        f"select ticker, {PERIODS[grain.name]} as {grain.period}, {METRICS_SQL}, "
        f"{tags_sql(grain.tags)}{extra} from {source} group by 1, 2"
    )


def metric_columns(grain: G.Grain) -> list[str]:
    extra = ["high_conf_sentiment"] if grain.high_conf else []
    return [*grain.keys, *grain.counts, "avg_sentiment", "weighted_sentiment", "avg_confidence", *extra]


def _add_summary(grain: G.Grain) -> None:
    @query(f"{grain.name}_summary", select(summary_sql(grain), "mentions"))
    def _summary(spark, sf):
        return G.summarize(stored_mentions(spark, sf), grain).select(*metric_columns(grain))


for _grain in G.GRAINS.values():
    _add_summary(_grain)


@query("mention_metrics", select(
    f"""select ticker, count(*) as mention_count, {_SUM['s']} / count(*) as avg_sentiment,
    {_SUM['c']} / count(*) as avg_confidence, cast(date_trunc('hour', created_at) as varchar) as hour_start
    from mentions group by ticker, hour_start""", "mentions"))
def _mention_metrics(spark, sf):
    return G.hourly_summary(stored_mentions(spark, sf)).select(
        "ticker", "mention_count", "avg_sentiment", "avg_confidence", "hour_start"
    )


@query("weighted_sentiment", select(
    f"""select ticker, case when {_SUM['c']} > 0 then {_SUM['sc']} / {_SUM['c']} else {_SUM['s']} / count(*) end
      as weighted_sentiment, {PERIODS['weekly']} as week_start from (
      select ticker, created_at, sentiment_compound, case when ticker = 'AMD' then 0.0 else confidence end
        as confidence from mentions) group by ticker, week_start""", "mentions"))
def _weighted_sentiment(spark, sf):
    """One ticker gets weights of 0 and so its plain mean."""
    weight = F.when(F.col("ticker") == "AMD", 0.0).otherwise(F.col("confidence"))
    rows = stored_mentions(spark, sf).withColumn("confidence", weight)
    return G.weekly_summary(rows).select("ticker", "weighted_sentiment", "week_start")


@query("signal_counts", select(
    f"select ticker, strftime(created_at, '%Y-%m-%d') as date, {tags_sql(G.DAILY.tags)} from mentions group by 1, 2",
    "mentions"))
def _signal_counts(spark, sf):
    sums = G.mention_sums(stored_mentions(spark, sf), G.DAILY)
    return sums.select("ticker", "date", *G.DAILY.counts[1:])


@query("high_conf_sentiment", select(
    f"select ticker, strftime(created_at, '%Y-%m-%d') as date, {HIGH_SQL} from mentions group by 1, 2", "mentions"))
def _high_conf_sentiment(spark, sf):
    sums = G.mention_sums(stored_mentions(spark, sf), G.DAILY)
    return G.means(sums, G.DAILY).select("ticker", "date", "high_conf_sentiment")


@query("price_target_histogram", select(
    """select ticker, strftime(created_at, '%Y-%m-%d') as date, cast(cast(substr(tag, 4) as double) as varchar) as key,
      count(*) as n from (select ticker, created_at, unnest(string_split(signals, ',')) as tag from mentions)
    where starts_with(tag, 'PT:') group by 1, 2, 3""", "mentions"))
def _price_target_histogram(spark, sf):
    sums = G.mention_sums(stored_mentions(spark, sf), G.DAILY)
    return G.count_map_rows(sums, G.DAILY.keys, "price_targets")


@query("subreddit_histogram", select(
    f"""select ticker, {PERIODS['hourly']} as hour_start, subreddit as key, count(*) as n from mentions
    where subreddit is not null group by 1, 2, 3""", "mentions"))
def _subreddit_histogram(spark, sf):
    sums = G.mention_sums(stored_mentions(spark, sf), G.HOURLY)
    return G.count_map_rows(sums, G.HOURLY.keys, "subreddits")


@query("daily_breakdown", select(
    f"""select ticker, {PERIODS['weekly']} as week_start, strftime(created_at, '%Y-%m-%d') as key, count(*) as n
    from mentions group by 1, 2, 3""", "mentions"))
def _daily_breakdown(spark, sf):
    sums = G.mention_sums(stored_mentions(spark, sf), G.WEEKLY)
    return G.count_map_rows(sums, G.WEEKLY.keys, "daily_breakdown")


TOP_SQL = """select ticker, strftime(created_at, '%Y-%m-%d') as date, rn as place, context, confidence,
    sentiment_compound as sentiment from (select *, row_number() over (
      partition by ticker, cast(created_at as date) order by confidence desc, message_id, context) as rn from mentions)
  where rn <= 3"""


@query("top_contexts", select(TOP_SQL, "mentions"))
def _top_contexts(spark, sf):
    dated = stored_mentions(spark, sf).withColumn("date", F.to_date("created_at"))
    best = G.top_contexts(dated, ["ticker", "date"])
    rows = best.select("ticker", "date", F.posexplode("top_contexts").alias("pos", "c"))
    return rows.select(
        "ticker", "date", (F.col("pos") + 1).cast("bigint").alias("place"),
        "c.context", "c.confidence", "c.sentiment",
    )


def _halves(rows):
    return (
        rows.where(F.col("created_at") < derived.BATCH_CUT),
        rows.where(F.col("created_at") >= derived.BATCH_CUT),
    )


def _half_hours(rows):
    """The first half of every hour, and the second with the mentions without a time: both
    batches touch the same hours, so that there is something to add up."""
    first = F.coalesce(F.minute("created_at") < 30, F.lit(False))
    return rows.where(first), rows.where(~first)


def _add_accumulate(grain: G.Grain, batches=_halves) -> None:
    @query(f"{grain.name}_accumulate", select(summary_sql(grain), "mentions"))
    def _accumulated(spark, sf):
        """Two batches added up equal one run over all mentions."""
        early, late = batches(stored_mentions(spark, sf))
        total = G.accumulate(
            G.summarize(early, grain, keep_sums=True), G.summarize(late, grain, keep_sums=True), grain
        )
        return total.select(*metric_columns(grain))


_add_accumulate(G.HOURLY, _half_hours)
_add_accumulate(G.WEEKLY)


@query("summary_replace", select(
    f"""select * from ({summary_sql(G.DAILY, 'late')}) union all
    select e.* from ({summary_sql(G.DAILY, 'early')}) e where not exists (
      select 1 from late l where l.ticker = e.ticker and strftime(l.created_at, '%Y-%m-%d') = e.date)""",
    "mentions", more=f"""early as (select * from mentions where created_at < timestamp '{derived.BATCH_CUT}'),
    late as (select * from mentions where created_at >= timestamp '{derived.BATCH_CUT}')"""))
def _summary_replace(spark, sf):
    """A day that both batches touch keeps the row of the second batch."""
    early, late = _halves(stored_mentions(spark, sf))
    merged = merge.replace_upsert(
        G.daily_summary(early), G.daily_summary(late), G.DAILY.keys
    )
    return merged.select(*metric_columns(G.DAILY))


@query("daily_delete_insert", select(
    f"select ticker, date, mention_count from ({summary_sql(G.DAILY)})", "mentions"))
def _daily_delete_insert(spark, sf):
    """A second run over the days from the 15th on: rows with an id that is stored are
    updated, others delete their ticker and day and are added; earlier days stay."""
    rows = stored_mentions(spark, sf)
    early, _ = _halves(rows)
    number = F.concat("ticker", F.date_format("date", "yyyyMMdd"))
    stored = G.daily_summary(early).withColumn("id", number)
    second = G.daily_summary(rows.where(F.to_date("created_at") >= "2024-01-15"))
    batch = second.withColumn("id", F.when(F.col("ticker") < "M", number))
    merged = merge.update_or_replace(stored, batch, "id", G.DAILY.keys)
    return merged.select("ticker", "date", "mention_count")


@query("summary_json", select(
    f"""select ticker, {PERIODS['hourly']} as hour_start, count(*) as mention_count,
      cast(count(distinct subreddit) as bigint) as forums from mentions group by 1, 2""", "mentions"))
def _summary_json(spark, sf):
    """Summaries with their maps as JSON text, as a sink without nested types takes them."""
    flat = as_json_columns(G.hourly_summary(stored_mentions(spark, sf)))
    forums = F.json_object_keys("subreddits")
    return flat.select("ticker", "hour_start", "mention_count", F.size(forums).cast("bigint").alias("forums"))


@query("last_24h", select(
    f"""select ticker, hour_start, mention_count from ({summary_sql(G.HOURLY)})
    where cast(hour_start as timestamp) >= (select max(date_trunc('hour', created_at)) from mentions)
      - interval 24 hour""", "mentions"))
def _last_24h(spark, sf):
    return G.hourly_summary(C.last_24h(stored_mentions(spark, sf))).select("ticker", "hour_start", "mention_count")


# -- reports --

SENTIMENT_SQL = """select subreddit, count(*) as message_count, avg(score) as avg_sentiment from (
  select subreddit, case when lower(content) like '%bullish%' or lower(content) like '%buy%' or lower(content) like '%up%'
    then 1 when lower(content) like '%bearish%' or lower(content) like '%sell%' or lower(content) like '%down%' then -1
    else 0 end as score from deduped where content is not null and length(content) > 0 and content <> '[deleted]')
group by 1 having count(*) > 10"""


@query("sentiment_by_subreddit", select(SENTIMENT_SQL, "deduped"))
def sentiment(spark, sf):
    return A.sentiment_by_subreddit(deduped(spark, sf)).drop("analysis_timestamp")


@query("count_by_type", select(
    "select message_type, count(*) as count from raw group by 1", "raw"))
def _count_by_type(spark, sf):
    return A.count_by_type(raw(spark, sf))


@query("top_subreddits", select(
    "select subreddit, count(*) as count from raw where subreddit is not null group by 1 "
    "order by 2 desc, 1 limit 10", "raw"))
def _top_subreddits(spark, sf):
    return A.top_subreddits(raw(spark, sf))


@query("daily_counts", select(
    "select strftime(created_at, '%Y-%m-%d') as date, count(*) as count from raw "
    "where content is not null and length(content) > 0 and content <> '[deleted]' group by 1", "raw"))
def _daily_counts(spark, sf):
    return A.daily_counts(raw(spark, sf))


ANALYSIS_SQL = """select count(*) as total_messages, count(*) filter (message_type = 'REDDIT_POST') as total_posts,
  count(*) filter (message_type = 'REDDIT_COMMENT') as total_comments,
  (select subreddit from raw group by 1 order by count(*) desc, 1 limit 1) as top_subreddit,
  (select count(*) from raw group by subreddit order by count(*) desc limit 1) as top_subreddit_count from raw"""


@query("analysis_summary", select(ANALYSIS_SQL, "raw"))
def _analysis_summary(spark, sf):
    return A.analysis_summary(raw(spark, sf)).drop("analysis_date")
