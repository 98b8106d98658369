"""Daily prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide import schemas
from tickertide import vocab as V

# -- fixed values: field names of the wide price frame, as delivered --
FIELDS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")


def price_long(wide: DataFrame, ticker: str | None = None, separator: str = "|") -> DataFrame:
    """Rows (Date, Ticker, measures) from a frame with a column per field and ticker.

    Columns are named ``field|ticker``. A frame of one ticker has bare field names and
    needs ``ticker``; it is empty if a field is missing. Days without any value are left
    out. The tickers are stacked row by row, without an exchange.
    """
    if ticker is not None:
        named = wide.withColumnRenamed("Adj Close", "Adj_Close").withColumn("Ticker", F.lit(ticker))
        required = ["Date", "Ticker", *V.PRICE_COLUMNS]
        if set(required) - set(named.columns):
            return wide.sparkSession.createDataFrame([], schemas.DAILY_PRICES)
        return named.select(*required)
    tickers = sorted({c.split(separator, 1)[1] for c in wide.columns if separator in c})
    present = set(wide.columns)

    def value(field: str, name: str):
        column = f"{field}{separator}{name}"
        found = F.col(f"`{column}`") if column in present else F.lit(None)
        return found.cast("double").alias(field.replace(" ", "_"))

    stacked = F.inline(
        F.array(*[
            F.struct(F.lit(t).alias("Ticker"), *[value(f, t) for f in FIELDS]) for t in tickers
        ])
    )
    return wide.select("Date", stacked).dropna("all", subset=list(V.PRICE_COLUMNS))


def price_cast(prices: DataFrame) -> DataFrame:
    """Date, doubles and a nullable whole volume."""
    return prices.select(
        F.to_date("Date").alias("Date"),
        "Ticker",
        *[F.col(c).cast("double").alias(c) for c in V.PRICE_COLUMNS[:-1]],
        F.col("Volume").cast("bigint").alias("Volume"),
    )


def price_concat(batches: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)


def price_totals(prices: DataFrame) -> DataFrame:
    """One row: distinct tickers and rows."""
    return prices.agg(
        F.countDistinct("Ticker").alias("tickers"), F.count("*").alias("n_rows")
    )
