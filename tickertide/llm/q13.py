"""Query of the conversation trie and its SQL."""

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.prefixes import prefix_trie, with_heads_of_block
from tickertide.llm.registry import query, table

# DuckDB has no crc32: for each digit one step that adds it and eight that shift.
TRIE_SQL = """
with recursive bytes as (
  select distinct conv_id as c, cast(conv_id as varchar) as s from conversations where conv_id is not null
),
crc as (
  select c, s, 0 as step, 4294967295::bigint as v from bytes
  union all
  select c, s, step + 1,
    case when step % 9 = 0 then xor(v, ascii(s[step // 9 + 1])::bigint)
    else xor(v >> 1, case when v & 1 = 1 then 3988292384::bigint else 0::bigint end) end
  from crc where step < 9 * length(s)
),
heads as (
  select c, xor(v, 4294967295::bigint) % 6 as h from crc where step = 9 * length(s)
),
turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) as p
  from conversations where conv_id is not null
),
rebuilt as (
  select heads.c, 0 as piece, p, role, text from heads join turns on turns.c = heads.c - heads.c % 100 and p <= h
  union all
  select heads.c, 1, p, role, text from heads join turns on turns.c = heads.c and p > h
),
placed as (
  select c, text, row_number() over w as d, sha256(role || chr(1) || text) as t from rebuilt window w as (partition by c order by piece, p)
),
paths as (
  select c, d, length(text) as chars, string_agg(t, '') over (partition by c order by d) as k from placed
  union all
  select c, 0, 0, '' from heads
),
lengths as (
  select c, max(d) as n from paths group by c
),
nodes as (
  select k, min(d) as depth, min(c) as conv_id, count(*) as n_convs, min(chars) as chars,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where d = n), '')) as ends_sha256
  from paths join lengths using (c) group by k
),
parents as (
  select nodes.*, parent.conv_id as parent_conv_id
  from nodes left join nodes parent on nodes.depth > 0 and parent.k = nodes.k[1:64 * (nodes.depth - 1)]
),
children as (
  select k[1:64 * (depth - 1)] as k, count(*) as n_children from nodes where depth > 0 group by 1
),
known as (
  select parents.*, coalesce(n_children, 0) as n_children from parents left join children using (k)
),
subtree as (
  select distinct up.k, down.k as below from paths up join paths down on up.c = down.c and down.d >= up.d
),
sums as (
  select subtree.k, count(*) filter (where n_children = 0) as n_leaves, sum((n_convs - 1) * chars) as saved_tokens
  from subtree join known on known.k = below group by subtree.k
)
select conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, ends_sha256
from known join sums using (k)
"""


@query("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), with_heads_of_block)
