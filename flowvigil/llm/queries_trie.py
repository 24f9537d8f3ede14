"""op13: the trie of conversation prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvigil.llm.prefix_trie import prefix_trie
from flowvigil.llm.registry import query, table

#: Unsigned CRC-32 of the bytes of a text; its polynomial is the usual one, reflected.
CRC_TABLE = """
crc_table as (
  select list(v order by i) as steps from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i)))
"""


def sql_crc32(text: str) -> str:
    """CRC-32 of a text column, in the dialect of the checking engine; needs ``steps``."""
    digits = f"hex(encode({text}))"
    byte = "(instr('0123456789ABCDEF', d[2 * k + 1]) - 1) * 16 + instr('0123456789ABCDEF', d[2 * k + 2]) - 1"
    numbers = (
        f"list_transform([{digits}], lambda d: list_transform(range(strlen({text})), lambda k: ({byte})::bigint))[1]"
    )
    return (
        f"xor(list_reduce(list_concat([4294967295::bigint], {numbers}), "
        "lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295)"
    )


SQL_TRIE = f"""
with {CRC_TABLE.strip()}, turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null
), plan as (
  select conv_id, conv_id - conv_id % 100 as base, ({sql_crc32('conv_id::varchar')} % 6)::bigint as h
  from (select distinct conv_id from turns), crc_table
), taken as (
  select p.conv_id, t.pos, t.role, t.text from plan p join turns t on t.conv_id = p.base and t.pos <= p.h
), own as (
  select p.conv_id, t.pos - p.h + coalesce(b.n, 0) as pos, t.role, t.text
  from plan p join turns t on t.conv_id = p.conv_id and t.pos > p.h
  left join (select conv_id, count(*) as n from taken group by conv_id) b on b.conv_id = p.conv_id
), rebuilt as (
  select * from taken union all select * from own
), prefixes as (
  select conv_id, pos as depth, length(text) as chars,
    string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by pos) as key
  from rebuilt
  union all select conv_id, 0, 0, '' from plan
), nodes as (
  select key, min(conv_id) as conv_id, any_value(depth)::bigint as depth, count(*)::bigint as n_convs, any_value(chars) as chars
  from prefixes group by key
), ends as (
  select key, string_agg(conv_id::varchar, ',' order by conv_id) as ids from prefixes p
  where depth = (select max(q.depth) from prefixes q where q.conv_id = p.conv_id) group by key
), children as (
  select left(key, length(key) - 32) as key, count(*)::bigint as n from nodes where key <> '' group by 1
), below as (
  select a.key, sum((n.n_convs - 1) * n.chars)::bigint as saved,
    count(*) filter (n.key not in (select key from children))::bigint as leaves
  from nodes n join prefixes a on a.conv_id = n.conv_id and a.depth <= n.depth group by a.key
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0)::bigint as n_children,
  b.leaves as n_leaves, b.saved as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join below b on b.key = n.key left join children c on c.key = n.key left join ends e on e.key = n.key
left join nodes p on n.key <> '' and p.key = left(n.key, length(n.key) - 32)
"""


@query("op13_prefix_trie", SQL_TRIE)
def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
