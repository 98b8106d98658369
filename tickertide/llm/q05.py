"""Query of the benchmark decontamination."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.decontam import contamination
from tickertide.llm.registry import query, table


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), nameless=True)
