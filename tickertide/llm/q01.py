"""Query of the language-model scorer."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm.ngram import score_texts
from tickertide.llm.registry import query, table


@query("op1_lm_score")
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(table(spark, sf_dir, "documents"), held_out, order=3)
