"""Query of the chat formatting."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.quotes import reply_ordered
from tickertide.llm.registry import query, table


@query("op4_quotes")
def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))
