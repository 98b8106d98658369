"""Query of the quality classifier."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.quality import score_documents
from tickertide.llm.registry import query, table


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
