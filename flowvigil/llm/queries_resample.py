"""op12: importance resampling of documents towards the benchmark texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvigil.llm.importance import importance_resample
from flowvigil.llm.queries_trie import CRC_TABLE, sql_crc32
from flowvigil.llm.registry import query, table

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL_RESAMPLE = f"""
with {CRC_TABLE.strip()}, split as (
  select row_number() over () as row, doc_id, coalesce({_WORDS}, []) as words from documents
), wanted as (
  select unnest({_WORDS}) as word from benchmark
), counted as (
  select row, word, count(*)::bigint as n from (select row, unnest(words) as word from split) group by row, word
), hashed as (
  select word, ({sql_crc32('word')} % 10000)::bigint as bucket
  from (select word from counted union select word from wanted), crc_table
), source as (
  select bucket, sum(n)::bigint as s from counted join hashed using (word) group by bucket
), target as (
  select bucket, count(*)::bigint as t from wanted join hashed using (word) group by bucket
), totals as (
  select (select coalesce(sum(s), 0) from source)::double as s_all, (select coalesce(sum(t), 0) from target)::double as t_all
), gains as (
  select bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000)) / ((coalesce(s, 0) + 1) * (t_all + 10000))))::bigint as gain
  from source full join target using (bucket), totals
), weighed as (
  select row, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight
  from counted join hashed using (word) join gains using (bucket) group by row
), scored as (
  select s.doc_id, coalesce(w.n_features, 0)::bigint as n_features, coalesce(w.weight, 0)::bigint as weight,
    (coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(s.doc_id::varchar, '')), 8))::bigint + 0.5::double)
      / 4294967296::double))))::bigint as score
  from split s left join weighed w on s.row = w.row
), ranked as (
  select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20
    order by score desc, doc_id nulls first, n_features, weight) end as place from scored
)
select doc_id, n_features, weight, score,
  case when place <= (select 10 * count(*) // 100 from scored where n_features >= 20) then place end::bigint as rank
from ranked
"""


@query("op12_importance_resampling", SQL_RESAMPLE)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
