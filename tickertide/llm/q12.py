"""Query of the whitened embeddings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm.registry import query, table
from tickertide.llm.whitening import whiten


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = rows.select(
        "row.vec_id", F.posexplode("whitened").alias("place", "whitened"), "n", F.col("deviation").cast("bigint").alias("deviation"), "explained", "identity_error"
    )
    explained = F.element_at("explained", F.col("place") + 1).alias("explained")
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", explained, "identity_error")
