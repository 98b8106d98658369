"""Query of the WARC round trip and its SQL."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.registry import query, table
from tickertide.llm.warc import archive_round_trip

# Base 32 of the SHA-1: five hex digits are four letters.
WARC_SQL = """
with digests as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
), tops as (
  select hex, max(page_id) as top from digests group by hex
)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast((cast('0x' || substr(hex, cast(g * 5 + 1 as int), 5) as bigint) >> cast(15 - 5 * i as int)) & 31 as int) + 1, 1)), '')), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from digests join tops using (hex)
"""


@query("op9_warc", WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
