"""Query of the repeated passages and its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm.registry import query, table
from tickertide.llm.repeats import remove_repeats

REPEATS_SQL = """
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
),
single as (
  select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from words
),
windows as (
  select doc_id, p, array_to_string(w[p:p + 19], ' ') as s
  from (select doc_id, unnest(range(1, len(w) - 18)) as p, w from words where len(w) >= 20)
),
firsts as (
  select s, min((doc_id, p)) as place from windows group by s having count(*) > 1
),
gone as (
  select distinct doc_id, p + k as p
  from (select doc_id, p from windows join firsts using (s) where (doc_id, p) > place), range(0, 20) as r(k)
),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as t from single anti join gone using (doc_id, p) group by 1
)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id)
"""


@query("op11_repeats", REPEATS_SQL)
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
