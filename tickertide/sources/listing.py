"""Exchange listing files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide import vocab as V
from tickertide.operators.universe import is_ticker


def listing_rows(raw: DataFrame, exchange: str, symbol: str) -> DataFrame:
    """Listed, valid, non-test symbols of one exchange."""
    ticker = F.col(f"`{symbol}`")
    return raw.where((F.col("`Test Issue`") == "N") & is_ticker(ticker)).select(
        F.trim(ticker).alias("ticker"),
        F.lit(exchange).alias("exchange"),
        F.trim("`Security Name`").alias("company_name"),
        F.current_timestamp().alias("last_updated"),
    )


def listing_scan(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Pipe-separated listing files per exchange, put together."""
    files = [
        listing_rows(
            spark.read.csv(path, sep="|", header=True, ignoreLeadingWhiteSpace=False),
            exchange,
            V.LISTING_SYMBOL_COLUMN[exchange],
        )
        for exchange, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, files)
