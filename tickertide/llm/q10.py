"""Query of the near-copy search."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.nearcopies import near_copies
from tickertide.llm.registry import query, table


@query("op10_probminhash")
def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
