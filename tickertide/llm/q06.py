"""Query of the URL filter."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.hostrank import filter_urls
from tickertide.llm.registry import query, table


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
