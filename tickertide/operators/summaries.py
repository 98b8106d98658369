"""Hourly, daily and weekly summaries of mentions.

One pass over the mentions computes the metrics and all count maps with grouping sets,
combined on the map side, so a ticker that holds most of the mentions costs no more than
any other. A second, small aggregation puts the rows of a period together. Means come
from exact decimal sums: the result does not depend on the order of the rows, and the
sums can be kept to add later batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions.text import float_text, signal_prices
from tickertide.functions.values import format_date, hour_start, merge_counts, week_start
from tickertide.operators.dedup import first_rows
from tickertide.operators.skew import skew_semi_join

EXACT = "decimal(18,6)"
BASE_TAGS = ("BUY", "SELL", "HOLD")
TOPIC_TAGS = ("NEWS", "EARNINGS", "TECHNICAL", "OPTIONS")
SUMS = (
    "sentiment_sum", "sentiment_n", "weight_sum", "weighted_sum", "confidence_n",
    "high_conf_sum", "high_conf_n",
)


@dataclass(frozen=True)
class Grain:
    """A summary table: its period column and what it holds beside the base metrics."""

    name: str
    period: str
    tags: tuple[str, ...]
    maps: tuple[str, ...]
    length: str
    high_conf: bool = False
    contexts: bool = False

    @property
    def keys(self) -> list[str]:
        return ["ticker", self.period]

    @property
    def counts(self) -> list[str]:
        return ["mention_count", *[tag_column(t) for t in self.tags]]

    def start(self, ts: Column) -> Column:
        if self.name == "hourly":
            return hour_start(ts)
        return F.to_date(ts) if self.name == "daily" else week_start(ts)


HOURLY = Grain("hourly", "hour_start", BASE_TAGS, ("subreddits",), "interval 1 hour")
DAILY = Grain(
    "daily", "date", BASE_TAGS + TOPIC_TAGS, ("price_targets", "subreddits"),
    "interval 1 day", high_conf=True, contexts=True,
)
WEEKLY = Grain(
    "weekly", "week_start", BASE_TAGS + TOPIC_TAGS,
    ("price_targets", "daily_breakdown", "subreddits"), "interval 7 days",
)
GRAINS = {g.name: g for g in (HOURLY, DAILY, WEEKLY)}


def tag_column(tag: str) -> str:
    return f"{tag.lower()}_signals"


def _map_key(name: str) -> Column:
    """The text a mention adds to the count map ``name``."""
    if name == "subreddits":
        return F.col("subreddit")
    if name == "daily_breakdown":
        return format_date(F.col("created_at"))
    return float_text(F.col("_target").try_cast("double"))


def measures(grain: Grain) -> list[Column]:
    sentiment = F.col("sentiment_compound").cast(EXACT)
    weight = F.when(F.col("sentiment_compound").isNotNull(), F.col("confidence")).cast(EXACT)
    weighted = (F.col("sentiment_compound") * F.col("confidence")).cast(EXACT)
    sure = F.col("confidence") > V.HIGH_CONFIDENCE

    def once(value: Column) -> Column:
        # A mention with several prices has further rows for these.
        return F.when(F.col("_main"), value)

    return [
        F.count_if("_main").alias("mention_count"),
        *[
            F.count_if(once(F.array_contains("signals", t))).alias(tag_column(t))
            for t in grain.tags
        ],
        F.sum(once(sentiment)).alias("sentiment_sum"),
        F.count(once(F.col("sentiment_compound"))).alias("sentiment_n"),
        F.sum(once(weight)).alias("weight_sum"),
        F.sum(once(weighted)).alias("weighted_sum"),
        F.sum(once(F.col("confidence").cast(EXACT))).alias("confidence_sum"),
        F.count(once(F.col("confidence"))).alias("confidence_n"),
        F.sum(once(F.when(sure, sentiment))).alias("high_conf_sum"),
        F.count(once(F.when(sure, F.col("sentiment_compound")))).alias("high_conf_n"),
        F.count("*").alias("_rows"),
    ]


def _with_targets(mentions: DataFrame, grain: Grain) -> DataFrame:
    """Add ``_main`` and ``_target``: a row for each price of a mention, one without any.

    All but the first row of a mention count for the prices only.
    """
    if "price_targets" not in grain.maps:
        return mentions.withColumn("_main", F.lit(True))
    prices = signal_prices(F.col("signals"))
    entry = F.transform(
        F.when(F.size(prices) > 0, prices).otherwise(F.array(F.lit(None).cast("string"))),
        lambda p, i: F.struct((i == 0).alias("main"), p.alias("price")),
    )
    rows = mentions.withColumn("_entry", F.explode(entry))
    return rows.withColumns({"_main": F.col("_entry.main"), "_target": F.col("_entry.price")}).drop("_entry")


def mention_sums(mentions: DataFrame, grain: Grain) -> DataFrame:
    """Counts, exact sums and count maps per ticker and period."""
    keys = grain.keys
    rows = _with_targets(mentions, grain)
    keyed = rows.withColumn(grain.period, grain.start(F.col("created_at"))).withColumns(
        {f"_{m}": _map_key(m) for m in grain.maps}
    )
    facets = [f"_{m}" for m in grain.maps]
    sums = measures(grain)
    sets = [keys, *[[*keys, f] for f in facets]]
    # Bit k of the id, counted from the right, is 0 where facet k takes part.
    grouped = keyed.groupingSets(sets, *keys, *facets).agg(
        *sums, F.grouping_id(*keys, *facets).alias("_set")
    )
    whole = 2 ** len(facets) - 1
    totals = [c for c in grouped.columns if c not in (*keys, *facets, "_set", "_rows")]

    def count_map(index: int) -> Column:
        one = whole - 2 ** (len(facets) - 1 - index)
        mine = (F.col("_set") == one) & F.col(facets[index]).isNotNull()
        number = "_rows" if facets[index] == "_price_targets" else "mention_count"
        entry = F.struct(F.col(facets[index]).alias("key"), F.col(number).alias("value"))
        return F.map_from_entries(F.sort_array(F.collect_list(F.when(mine, entry))))

    return grouped.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_set") == whole, F.col(c))).alias(c) for c in totals],
        *[count_map(i).alias(m) for i, m in enumerate(grain.maps)],
    )


def _mean(total: str, number: str) -> Column:
    return F.col(total).cast("double") / F.nullif(F.col(number), F.lit(0))


def means(sums: DataFrame, grain: Grain, keep_sums: bool = False) -> DataFrame:
    """Summary columns from the sums. The weighted mean is the plain mean where the
    weights do not add up to more than 0."""
    plain = _mean("sentiment_sum", "sentiment_n")
    derived = {
        "avg_sentiment": plain,
        "weighted_sentiment": F.when(
            F.col("weight_sum") > 0,
            F.col("weighted_sum").cast("double") / F.col("weight_sum").cast("double"),
        ).otherwise(plain),
        "avg_confidence": _mean("confidence_sum", "confidence_n"),
    }
    if grain.high_conf:
        derived["high_conf_sentiment"] = _mean("high_conf_sum", "high_conf_n")
    table = sums.withColumns(derived)
    extra = ["confidence_sum", *SUMS] if keep_sums else []
    return table.select(
        *grain.keys, *grain.counts, *derived, *[m for m in grain.maps if m in table.columns],
        *(["top_contexts"] if "top_contexts" in table.columns else []), *extra,
    )


def top_contexts(
    mentions: DataFrame, keys: list[str], n: int = V.TOP_CONTEXTS, keep_ids: bool = False
) -> DataFrame:
    """The most confident contexts per group. Ranked before they are collected.

    ``keep_ids`` keeps their message_id, by which ties are broken when groups are merged.
    """
    order = [F.desc_nulls_last("confidence"), F.asc("message_id"), F.asc("context")]
    best = first_rows(
        mentions.select(*keys, "confidence", "message_id", "context", "sentiment_compound"),
        keys, order, n,
    )
    item = F.struct(
        F.isnull("confidence").alias("unsure"), (-F.col("confidence")).alias("rank"),
        "message_id", "context", "confidence",
        F.col("sentiment_compound").alias("sentiment"),
    )
    ids = ["message_id"] if keep_ids else []
    return best.groupBy(*keys).agg(
        _context_fields(F.sort_array(F.collect_list(item)), ids).alias("top_contexts")
    )


def _context_fields(contexts: Column, more: Sequence[str] = ()) -> Column:
    names = ["context", "confidence", "sentiment", *more]
    return F.transform(contexts, lambda c: F.struct(*[c[n].alias(n) for n in names]))


def without_ids(sums: DataFrame) -> DataFrame:
    """Summary rows from rows with sums, whose contexts have ids."""
    if "top_contexts" not in sums.columns:
        return sums
    return sums.withColumn("top_contexts", _context_fields(F.col("top_contexts")))


def summarize(mentions: DataFrame, grain: Grain, keep_sums: bool = False) -> DataFrame:
    """Summary rows per ticker and period."""
    sums = mention_sums(mentions, grain)
    if grain.contexts:
        dated = mentions.withColumn(grain.period, grain.start(F.col("created_at")))
        sums = sums.join(top_contexts(dated, grain.keys, keep_ids=keep_sums), grain.keys, "left")
    return means(sums, grain, keep_sums).withColumn("etl_timestamp", F.current_timestamp())


def hourly_summary(mentions: DataFrame) -> DataFrame:
    return summarize(mentions, HOURLY)


def daily_summary(mentions: DataFrame) -> DataFrame:
    return summarize(mentions, DAILY)


def weekly_summary(mentions: DataFrame) -> DataFrame:
    return summarize(mentions, WEEKLY)


def count_map_rows(summary: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A count map as rows (keys, key, n)."""
    return summary.select(*keys, F.explode(name).alias("key", "n"))


def accumulate(stored: DataFrame, new: DataFrame, grain: Grain) -> DataFrame:
    """Add a batch to stored summaries: counts, maps and sums add up, means follow.

    Both sides come from ``summarize(..., keep_sums=True)`` and have one row per key.
    Contexts are not additive; the best of both sides stay.
    """
    keys = grain.keys
    sums = ["confidence_sum", *SUMS]

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"a.{name}"), F.col(f"b.{name}")

    def add(name: str) -> Column:
        old, fresh = both(name)
        total = F.coalesce(old, F.lit(0)) + F.coalesce(fresh, F.lit(0))
        kind = "bigint" if name in grain.counts or name.endswith("_n") else "decimal(28,6)"
        return F.when(old.isNull() & fresh.isNull(), F.lit(None)).otherwise(total).cast(kind)

    def best(old: Column, fresh: Column) -> Column:
        none = F.array().cast("array<struct<context:string,confidence:double,sentiment:double,message_id:string>>")
        joined = F.concat(F.coalesce(old, none), F.coalesce(fresh, none))
        # In the order of ``top_contexts``: sure ones first, then by message and text.
        ranked = F.transform(
            joined,
            lambda c: F.struct(
                F.isnull(c["confidence"]).alias("unsure"), (-c["confidence"]).alias("rank"),
                c["message_id"].alias("message_id"), c["context"].alias("context"),
                c["confidence"].alias("confidence"), c["sentiment"].alias("sentiment"),
            ),
        )
        return _context_fields(F.slice(F.sort_array(ranked), 1, V.TOP_CONTEXTS), ["message_id"])

    merged = stored.alias("a").join(new.alias("b"), keys, "full").select(
        *keys,
        *[add(c).alias(c) for c in (*grain.counts, *sums)],
        *[merge_counts(*both(m)).alias(m) for m in grain.maps],
        *([best(*both("top_contexts")).alias("top_contexts")] if grain.contexts else []),
    )
    return means(merged, grain, keep_sums=True).withColumn("etl_timestamp", F.current_timestamp())


def touched_periods(mentions: DataFrame, new: DataFrame, grain: Grain) -> DataFrame:
    """All stored mentions of the (ticker, period) groups that ``new`` touches.

    The span of the touched periods bounds what is read: by ``event_date`` where the table
    is laid out by day, and by the time of the mention.
    """
    start = grain.start(F.col("created_at"))
    touched = new.select("ticker", start.alias(grain.period)).distinct()
    first = touched.select(F.min(grain.period).cast("timestamp")).scalar()
    after = touched.select(F.max(grain.period).cast("timestamp") + F.expr(grain.length)).scalar()
    created = F.col("created_at")
    wanted = (created >= first) & (created < after)
    if "event_date" in mentions.columns:
        wanted = wanted & F.col("event_date").between(F.to_date(first), F.to_date(after))
    stored = mentions.where(wanted).withColumn(grain.period, start)
    return skew_semi_join(stored, touched, grain.keys).drop(grain.period)

