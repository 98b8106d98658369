"""Query of the mixing operator and its SQL."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.mixing import taken_words
from tickertide.llm.registry import query, table

# The words taken follow from hashes of ids; the split among shards does not change them.
MIX_SQL = r"""
with sizes as materialized (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h,
    cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) % 1024 as block
  from documents
), placed as (
  select source, cast(sum(size) as bigint) as size, row_number() over (order by source asc nulls last) - 1 as place
  from sizes group by source
), capped as (
  select *, case place % 3 when 0 then 5 when 1 then 2 else 1 end as weight, size * 2 as cap,
    cast(size * 2 as double) / case place % 3 when 0 then 5 when 1 then 2 else 1 end as ratio
  from placed
), levels as (
  select *, (sum(size) over () * 1.5::double - coalesce(sum(cap) over (order by ratio, place rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, place rows between unbounded preceding and 1 preceding), 0)) as level
  from capped
), chosen as (
  select level from levels where level <= ratio order by ratio, place limit 1
), sources as (
  select source, place, size, least(cast(cap as double), coalesce((select level from chosen), 0) * weight) as target from levels
), passes as (
  select *, case when size > 0 then cast(floor(target / size) as bigint) else 0 end as passes,
    target - case when size > 0 then floor(target / size) else 0 end * size as rest from sources
), blocks as (
  select s.place, any_value(s.passes) as passes, any_value(s.rest) as rest, d.block, cast(sum(d.size) as bigint) as words
  from sizes d join passes s on d.source is not distinct from s.source group by s.place, d.block
), ordered as (
  select *, coalesce(sum(words) over (partition by place order by
    cast('0x' || substr(md5('mix|order|' || place || '|' || block), 1, 15) as bigint), block
    rows between unbounded preceding and 1 preceding), 0) as before from blocks
), docs as (
  select d.*, s.place, s.size as source_size, s.target, s.passes, s.rest, o.before, o.words,
    o.before <= s.rest and o.before + o.words > s.rest as last
  from sizes d join passes s on d.source is not distinct from s.source join ordered o on o.place = s.place and o.block = d.block
), misses as (
  select place, h, abs(sum(size) over (partition by place order by h range between unbounded preceding and current row)
    - (rest - before)) as miss, rest - before as space
  from docs where last
), cuts as (
  select place, case when min(miss) < min(space) then arg_min(h, (miss, h)) else -1 end as cut from misses group by place
)
select doc_id, size, source_size, target,
  cast(size * (passes + case when before + words <= rest then 1 when last and h <= cut then 1 else 0 end) as bigint) as taken
from docs left join cuts using (place)
"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))
