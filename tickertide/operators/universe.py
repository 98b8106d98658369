"""The set of tickers that count as mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide import vocab as V


def is_ticker(symbol: Column) -> Column:
    """One to five capital letters."""
    return symbol.rlike(V.TICKER_PATTERN)


def listing_symbols(listing: DataFrame) -> DataFrame:
    """Distinct valid symbols of a listing."""
    return listing.select("ticker").where(is_ticker(F.col("ticker"))).distinct()


def require_rows(df: DataFrame, message: str = "no valid tickers") -> DataFrame:
    """``df`` itself; raises if it is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def valid_tickers(table: DataFrame) -> DataFrame:
    ticker = F.col("ticker")
    return (
        table.select("ticker")
        .where(ticker.isNotNull() & F.length(ticker).between(1, 5) & ticker.rlike("^[A-Z]+$"))
        .distinct()
    )


def index_fallback_universe(listed: DataFrame) -> DataFrame:
    """Index tickers and the listed symbols that are valid in upper case."""
    index = listed.sparkSession.createDataFrame([(t,) for t in V.INDEX_TICKERS], "ticker string")
    symbols = listed.select(F.upper("ticker").alias("ticker")).where(is_ticker(F.col("ticker")))
    return index.unionByName(symbols).distinct()


def volume_universe(prices: DataFrame, size: int = V.UNIVERSE_SIZE) -> DataFrame:
    """The ``size`` tickers of the largest mean volume; invalid symbols are dropped after
    the cut, as the rule says, so fewer may remain."""
    return (
        prices.groupBy("ticker")
        .agg(F.avg("volume").alias("avg_volume"))
        .orderBy(F.desc_nulls_last("avg_volume"), "ticker")
        .limit(size)
        .where(is_ticker(F.col("ticker")))
    )


def latest_volume_top_n(listed: DataFrame, prices: DataFrame, size: int = V.UNIVERSE_SIZE) -> DataFrame:
    """Listed tickers by their latest volume, 0 where there is none."""
    latest = prices.groupBy("ticker").agg(F.max_by("volume", "trade_date").alias("volume"))
    return (
        listed.select("ticker")
        .distinct()
        .join(latest, "ticker", "left")
        .select("ticker", F.coalesce("volume", F.lit(0)).alias("volume"))
        .orderBy(F.desc("volume"), "ticker")
        .limit(size)
    )
