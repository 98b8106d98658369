"""Query of the exact deduplication and its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm.exact import duplicate_groups
from tickertide.llm.registry import query, table

EXACT_SQL = """
with groups as (
  select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size from documents group by 1
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256
from documents join groups on t = coalesce(text, '')
"""


@query("op3_exact_dedup", EXACT_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")
