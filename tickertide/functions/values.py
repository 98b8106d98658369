"""Times, JSON and count maps."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def to_ts(value: Column, data_type: T.DataType) -> Column:
    """Timestamp from a timestamp, epoch seconds or ISO text; null where it cannot be read."""
    if isinstance(data_type, T.NumericType):
        return F.timestamp_seconds(value.cast("double"))
    if isinstance(data_type, T.StringType):
        return F.when(value.rlike(_ISO), F.try_to_timestamp(value))
    return value.cast("timestamp")


def with_ts(df: DataFrame, *names: str) -> DataFrame:
    """Replace the named columns by timestamps, whatever type they arrive in."""
    return df.withColumns({n: to_ts(F.col(n), df.schema[n].dataType) for n in names})


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", ts)


def strip_zone(ts: Column) -> Column:
    """Wall-clock time without a zone; a date becomes midnight."""
    return ts.cast("timestamp_ntz")


def wall_clock(text: Column) -> Column:
    """Wall-clock part of ISO text with an offset: the offset is dropped, not applied."""
    return F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def format_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def format_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_iso(ts: Column) -> Column:
    """ISO text; the fraction appears only where there is one."""
    fraction = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == "000000", seconds).otherwise(F.concat_ws(".", seconds, fraction))


def json_or(text: Column, schema: str, default: Column) -> Column:
    """Parsed JSON, ``default`` where the text is null, empty or not JSON."""
    return F.coalesce(F.from_json(text, schema), default)


def json_text(value: Column) -> Column:
    """JSON text with ISO dates, ``{}`` for null."""
    options = {
        "dateFormat": "yyyy-MM-dd",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    }
    return F.coalesce(F.to_json(value, options), F.lit("{}"))


def no_counts() -> Column:
    return F.create_map().cast("map<string,bigint>")


def merge_counts(left: Column, right: Column) -> Column:
    """Sum of two count maps, key by key."""
    return F.map_zip_with(
        F.coalesce(left, no_counts()),
        F.coalesce(right, no_counts()),
        lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    )


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float))


def merge_values(first: object, second: object) -> object:
    """Maps merge, lists join, numbers add; otherwise the second value wins."""
    if isinstance(first, dict) and isinstance(second, dict):
        shared = {k: merge_values(first[k], second[k]) for k in first.keys() & second.keys()}
        return {**first, **second, **shared}
    if isinstance(first, list) and isinstance(second, list):
        return first + second
    if _is_number(first) and _is_number(second):
        return first + second
    return second


@F.pandas_udf(T.StringType())
def merge_json(left: pd.Series, right: pd.Series) -> pd.Series:
    """Merge JSON objects of unknown shape. Unless both are objects the first non-null stays."""

    def merge(a: str | None, b: str | None) -> str | None:
        if a is None or b is None:
            return a if a is not None else b
        first, second = json.loads(a), json.loads(b)
        if isinstance(first, dict) and isinstance(second, dict):
            return json.dumps(merge_values(first, second))
        return a if first is not None else b

    return pd.Series([merge(a, b) for a, b in zip(left, right)], dtype="object")
