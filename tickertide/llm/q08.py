"""Query of the text extraction."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.html import extract_text
from tickertide.llm.registry import query, table


@query("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
