"""Filters and projections on messages."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.functions.text import full_text, has_visible_text
from tickertide.functions.values import hour_start, to_ts


def valid_content(df: DataFrame) -> DataFrame:
    """Content is present, not empty and not deleted."""
    content = F.col("content")
    return df.where(content.isNotNull() & (F.length(content) > 0) & (content != V.DELETED))


def drop_deleted(df: DataFrame) -> DataFrame:
    """Drop rows with deleted content; rows without content stay."""
    return df.where(~F.col("content").eqNullSafe(V.DELETED))


def deleted_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("content") == V.DELETED)


def since_watermark(
    df: DataFrame, last_run: datetime | Column | None, column: str = "created_at"
) -> DataFrame:
    """Rows after the last run, whose time is cut to whole seconds; all rows without one.

    ``column='ingestion_timestamp'`` also keeps rows that were created before the last
    run and arrived after it.
    """
    if last_run is None:
        return df
    cut = F.date_trunc("second", F.lit(last_run).cast("timestamp"))
    return df.where(F.col(column) > cut)


def hours_back(df: DataFrame, hours: int, now: datetime | Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` hours before ``now``."""
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return since_watermark(df, moment - F.make_dt_interval(hours=F.lit(hours)))


def last_24h(mentions: DataFrame) -> DataFrame:
    """Mentions from 24 hours before the hour of the newest one on, to be summed by hour.

    Only the time column is read for the newest one; where the table is laid out by day, the
    filter reaches its folders.
    """
    newest = mentions.select(F.date_trunc("hour", F.max("created_at"))).head()[0]
    if newest is None:
        return mentions.limit(0)
    first = F.lit(newest - timedelta(hours=24))
    recent = F.col("created_at") >= first
    if "event_date" in mentions.columns:
        recent = recent & (F.col("event_date") >= F.to_date(first))
    return mentions.where(recent)


def normalize_message(df: DataFrame, source: str | None = V.DEFAULT_SOURCE) -> DataFrame:
    """Staged documents (``document_id``, ``id``, message fields) as raw messages.

    Fields the documents lack become null. ``source=None`` leaves a missing source null.
    """
    have = dict(df.dtypes)

    def field(name: str, kind: str = "string") -> Column:
        value = F.col(name) if name in have else F.lit(None)
        return value.cast(kind)

    def time(name: str) -> Column:
        return to_ts(F.col(name), df.schema[name].dataType) if name in have else field(name, "timestamp")

    origin = field("source")
    return df.select(
        field("document_id").alias("document_id"),
        field("id").alias("message_id"),
        *[field(n).alias(n) for n in ("content", "author")],
        time("timestamp").alias("timestamp"),
        field("url").alias("url"),
        field("score", "bigint").alias("score"),
        time("created_at").alias("created_at"),
        field("message_type").alias("message_type"),
        (F.coalesce(origin, F.lit(source)) if source else origin).alias("source"),
        *[field(n).alias(n) for n in ("title", "selftext")],
        field("num_comments", "bigint").alias("num_comments"),
        *[field(n).alias(n) for n in ("subreddit", "parent_id", "submission_id")],
        field("depth", "int").alias("depth"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def deleted_author_default(df: DataFrame) -> DataFrame:
    return df.withColumn("author", F.coalesce("author", F.lit(V.DELETED)))


def with_full_text(df: DataFrame) -> DataFrame:
    """Add ``text``, drop rows where it is blank."""
    return df.withColumn("text", full_text(F.col("title"), F.col("content"))).where(
        has_visible_text(F.col("text"))
    )


def content_contains(df: DataFrame, part: str) -> DataFrame:
    """Any-case substring filter."""
    return df.where(F.contains(F.lower("content"), F.lit(part.lower())))


def created_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("created_hour", F.hour("created_at"))


def with_hour_start(df: DataFrame) -> DataFrame:
    return df.withColumn("hour_start", hour_start(F.col("created_at")))


def regex_count(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).rlike(pattern)).alias("n"))


def comments_count(df: DataFrame) -> DataFrame:
    """Number of comments; articles have none."""
    number = F.when(F.col("message_type") == V.ARTICLE, F.lit(0)).otherwise(F.col("num_comments"))
    return df.withColumn("comments_count", number)


def posts_by_activity(df: DataFrame, at_least: int, at_most: int | None = None) -> DataFrame:
    """Posts with a number of comments in a range, or of at least so many."""
    number = F.col("num_comments")
    wanted = number >= at_least if at_most is None else number.between(at_least, at_most)
    return df.where((F.col("message_type") == V.POST) & wanted)


def feed(df: DataFrame, mode: str, since: Column | None = None) -> DataFrame:
    """Posts ``new`` first, or ``top`` by score within a period."""
    posts = df.where(F.col("message_type") == V.POST)
    if since is not None:
        posts = posts.where(F.col("created_at") >= since)
    keys = {"new": ["created_at"], "top": ["score", "created_at"]}[mode]
    return posts.orderBy(*[F.desc(k) for k in keys], "message_id")
