"""op6, op7 and op8: the operators written in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.llm.chat_format import format_conversations, read_back, text_parts
from flowvigil.llm.line_dedup import remove_repeated_windows
from flowvigil.llm.pii import find_pii
from flowvigil.llm.pii_sql import SQL_PII
from flowvigil.llm.registry import query, table

SQL_LINES = r"""
with lines as (
  select doc_id, string_split(text, chr(10)) as l from documents where text is not null
), windows as (
  select doc_id, unnest(range(0, len(l) - 2)) as i, l from lines where len(l) >= 3
), keyed as (
  select doc_id, i, [l[i + 1], l[i + 2], l[i + 3]] as w from windows
  where trim(l[i + 1] || l[i + 2] || l[i + 3], ' ') <> ''
), ranked as (
  select doc_id, i, row_number() over (partition by w order by doc_id, i) as r from keyed
), gone as (
  select distinct doc_id, i + k as i from ranked, (values (0), (1), (2)) t(k) where r > 1
), numbered as (
  select doc_id, unnest(range(0, len(l))) as i, l from lines
), kept as (
  select n.doc_id, string_agg(n.l[n.i + 1], chr(10) order by n.i) as text
  from numbered n anti join gone g on n.doc_id = g.doc_id and n.i = g.i group by n.doc_id
), removed as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, coalesce(len(l.l), 0)::bigint as n_lines, coalesce(r.n, 0)::bigint as n_removed,
  case when d.text is null then null else sha256(coalesce(k.text, '')) end as kept_sha256
from documents d left join lines l on d.doc_id = l.doc_id
left join removed r on d.doc_id = r.doc_id left join kept k on d.doc_id = k.doc_id
"""


@query("op6_line_dedup", SQL_LINES)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


BASE = ("email", "ip", "card", "phone")


def _count(name: str) -> Column:
    of_kind = F.filter("pii", lambda span: span["kind"] == name)
    return F.size(of_kind).cast("bigint").alias(f"n_{name}")


@query("op7_pii", SQL_PII)
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda span: span["base"])
    joined = lambda spans: F.array_join(
        F.transform(
            spans,
            lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string")),
        ),
        ",",
    )
    counts = [_count(name) for name in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


SQL_CHAT = r"""
with messages as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped as (
  select *, regexp_replace(regexp_replace(replace(text, '&', '&amp;'), '<(/?s>|\|)', '&lt;\1', 'g'),
    '\[(/?INST\])', '&lb;\1', 'g') as body from messages
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('<|turn:' || role || '|>' || chr(10) || body || '<|end|>' || chr(10)))::bigint as formatted_chars
from escaped group by conv_id
"""


@query("op8_chat_format", SQL_CHAT)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    messages = rows.unionByName(planted).select(
        "conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")
    )
    formatted = format_conversations(messages).select(
        "conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"),
        read_back(F.col("formatted"), F.col("mask")).alias("turns"),
    )
    whole = F.array_join(
        F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(
        F.transform(F.filter("turns", lambda turn: turn["loss"]), lambda turn: turn["text"]), ""
    )
    return formatted.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
