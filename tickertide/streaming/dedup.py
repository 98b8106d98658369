"""Streams of messages without copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.operators.clean import valid_content

SALTS = 16


def dedup_stream(messages: DataFrame, delay: str = "2 hours", spread: str = "created_at") -> DataFrame:
    """Valid messages, each id once; copies may arrive up to ``delay`` apart in event time.

    Two steps: the copies of an id are first spread over several tasks by column
    ``spread``, each of which lets one through, so an id with very many copies does not
    end up in one task.
    """
    salted = (
        valid_content(messages)
        .withWatermark("created_at", delay)
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    )
    first = salted.dropDuplicatesWithinWatermark(["message_id", "_salt"])
    return first.drop("_salt").dropDuplicatesWithinWatermark(["message_id"])
