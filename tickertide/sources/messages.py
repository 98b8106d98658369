"""Scans of messages and staged documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.operators.clean import since_watermark, valid_content
from tickertide.operators.dedup import dedup_by_event_time

MESSAGE_COLUMNS = (
    "message_id", "content", "author", "created_at", "subreddit", "title", "url", "score",
    "message_type",
)


def newest(df: DataFrame, n: int | None = None) -> DataFrame:
    """Newest first, ``n`` rows or all."""
    ordered = df.orderBy(F.desc("created_at"), "message_id")
    return ordered.limit(n) if n else ordered


def scan_messages(
    messages: DataFrame,
    last_run: datetime | Column | None = None,
    limit: int | None = None,
    ordered: bool = False,
    arrival: str = "created_at",
    **by_id: object,
) -> DataFrame:
    """Valid messages since the last run, one row per id.

    ``by_id`` is ``row_id`` and ``fetch`` of ``dedup.first_rows``. With a limit the newest are returned. Without one the order is only made on request,
    because it would sort the whole table.
    """
    wanted = since_watermark(valid_content(messages), last_run, arrival)
    extra = [c for c in ("event_id", by_id.get("row_id")) if c in messages.columns]
    needed = dict.fromkeys([*MESSAGE_COLUMNS, "timestamp", *extra])
    rows = dedup_by_event_time(wanted.select(*needed), **by_id).select(*MESSAGE_COLUMNS)
    return newest(rows, limit) if limit or ordered else rows


def recent_valid_messages(messages: DataFrame, n: int) -> DataFrame:
    """Newest valid rows, copies included."""
    return newest(valid_content(messages).select(*MESSAGE_COLUMNS), n)


def scan_staging(
    spark: SparkSession,
    path: str,
    schema: str,
    limit: int | None = None,
    key: str = "document_id",
) -> DataFrame:
    """Staged JSON documents; with a limit the first by document id."""
    staged = spark.read.schema(schema).json(path)
    return staged.orderBy(key).limit(limit) if limit else staged


def staging_with_key(spark: SparkSession, path: str, schema: str, key: str = "document_id") -> DataFrame:
    """The whole staging collection; the document id replaces the field ``id``."""
    return spark.read.schema(schema).json(path).withColumn("id", F.col(key)).drop(key)
