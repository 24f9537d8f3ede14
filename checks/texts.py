"""Scalar functions, URIs, syslog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql_parts as sp
from checks.registry import query
from flowvigil.functions import (
    clean_uri,
    java_hash,
    parse_time,
    uri_decode,
    uri_normalize,
    uri_tokens,
    uri_words,
)
from flowvigil.functions.segments import WordCosts, word_counts
from flowvigil.operators.embedding import word_information
from flowvigil.operators.http import http_flows
from flowvigil.operators.route import is_http
from flowvigil.operators.syslog import (
    GENLOG_COLUMNS,
    SyslogPattern,
    classify,
    envelope,
    genlog_fields,
    syslog_rows,
)
from flowvigil.operators.uri_flows import recent_queries, training_rows
from flowvigil.plans.uri_model import word_tokenizer
from flowvigil.session import work_folder
from flowvigil.sources.patterns import (
    VENDOR_PATTERNS,
    pattern_table,
    read_patterns,
    write_patterns,
)

DAYS = 7


def _line_id() -> Column:
    return F.substring_index("value", "|!", 1).cast("bigint").alias("event_id")


@query(
    "parse_time",
    """
select event_id, case when event_id % 7 = 6 then 0 else {EPOCH} end as epoch
from events
""".replace("{EPOCH}", fx.DUCKDB_EPOCH),
)
def _parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")))
    millis = (F.unix_seconds(at) * 1000).cast("string")
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, F.date_format(at, "dd/MMM/yyyy:HH:mm:ss"))
        .when(kind == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.unix_seconds(at).cast("string"))
        .when(kind == 3, millis)
        .when(kind == 4, F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit("  ")))
        .when(kind == 5, F.concat(F.date_format(at, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000")))
        .otherwise(F.concat(F.lit("at "), F.date_format(at, "yyyy-MM-dd HH:mm:ss")))
    )
    texts = fx.events(spark, sf_dir).select("event_id", text.alias("time"))
    return texts.select("event_id", parse_time(F.col("time")).alias("epoch"))


@query("java_hash", f"select page_id, {sp.hashed('url')} as hash from pages")
def _java_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "pages").select("page_id", java_hash(F.col("url")).alias("hash"))


_URIS = """
with uris as (
  select 'page' as source, page_id as id, url as uri from pages
  union all select 'flow', event_id, uri from fx_http)"""


def _uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("source"), F.col("page_id").alias("id"), F.col("url").alias("uri")
    )
    flows = fx.http_columns(fx.events(spark, sf_dir)).select(
        F.lit("flow").alias("source"), F.col("event_id").alias("id"), "uri"
    )
    return pages.unionByName(flows)


@query("uri_decode", f"{_URIS} select source, id, {sp.decoded('uri')} as text from uris")
def _uri_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uris(spark, sf_dir).select("source", "id", uri_decode(F.col("uri")).alias("text"))


@query(
    "uri_normalize",
    f"{_URIS} select source, id, {sp.normalized(sp.decoded('uri'))} as text from uris",
)
def _uri_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = uri_normalize(uri_decode(F.col("uri")))
    return _uris(spark, sf_dir).select("source", "id", text.alias("text"))


@query("uri_tokens", f"{_URIS} select source, id, {sp.cleaned('uri')} as text from uris")
def _uri_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = uri_tokens(uri_normalize(uri_decode(F.col("uri"))))
    return _uris(spark, sf_dir).select("source", "id", text.alias("text"))


LEAST, LONGEST, MOST_WORDS = 3, 12, 20_000
_LETTERS = f"regexp_replace({sp.decoded('uri')}, '[^a-z]', '', 'g')"


@query(
    "uri_least_cost",
    f"""
with recursive {_URIS.strip().removeprefix('with ')},
spoken as (select unnest(string_split({sp.words(sp.tokens(sp.decoded('uri')))}, ' ')) as word from uris),
counted as (
  select word, count(*) as n from spoken where regexp_full_match(word, '[a-z]{{2,{LONGEST}}}')
  group by word having count(*) >= {LEAST} order by n desc, word limit {MOST_WORDS}),
total as (select sum(n)::double as n from counted),
costs as (
  select map(list(word), list(floor(1000 * ln(total.n / counted.n))::bigint)) as cost,
    floor(1000 * ln(10 * any_value(total.n)))::bigint as unknown from counted, total),
texts as (select distinct {_LETTERS} as text from uris),
ways as (
  select text, 0::bigint as pos, [{{'cost': 0::bigint, 'pieces': 0::bigint, 'start': 0::bigint}}] as best from texts
  union all
  select text, pos + 1, list_append(best, list_sort(list_filter(list_transform(range(greatest(0, pos + 1 - {LONGEST}), pos + 1),
    lambda k: {{'cost': best[k + 1].cost + coalesce(cost[substr(text, k + 1, pos + 1 - k)], case when k = pos then unknown end),
      'pieces': best[k + 1].pieces + 1, 'start': k}}), lambda w: w.cost is not null))[1])
  from ways, costs where pos < length(text)),
back as (
  select text, pos as stop, best, [] :: varchar[] as pieces from ways where pos = length(text)
  union all
  select text, best[stop + 1].start, best,
    list_prepend(substr(text, best[stop + 1].start + 1, stop - best[stop + 1].start), pieces)
  from back where stop > 0)
select source, id, array_to_string(pieces, '|') as text
from uris join back on back.text = {_LETTERS} and stop = 0
""",
)
def _uri_least_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of each address run together, and cut into the words that addresses are made of."""
    decoded = _uris(spark, sf_dir).select("source", "id", uri_decode(F.col("uri")).alias("uri"))
    spoken = decoded.select(uri_words(uri_tokens(F.col("uri"))).alias("words"))
    costs = WordCosts.of_counts(word_counts(spoken, "words", LEAST, LONGEST, MOST_WORDS))
    lettered = decoded.select("source", "id", F.regexp_replace("uri", "[^a-z]", "").alias("letters"))
    # Addresses that differ in numbers have the same letters, which are cut once.
    cut = lettered.select("letters").distinct().select("letters", uri_tokens(F.col("letters"), costs).alias("text"))
    return lettered.join(cut, "letters", "left").select("source", "id", "text")


@query("uri_words", f"{_URIS} select source, id, {sp.words(sp.cleaned('uri'))} as text from uris")
def _uri_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the stage that models use, and by the expression that stands for it."""
    cleaned = _uris(spark, sf_dir).select("source", "id", clean_uri(F.col("uri")).alias("uri"))
    staged = word_tokenizer("uri").transform(cleaned)
    same = F.array_join(F.when(F.col("words") == uri_words(F.col("uri")), F.col("words")), " ")
    return staged.select("source", "id", same.alias("text"))


LEXICON = ("union", "select", "item", "name", "luannumber", "http")


@query(
    "uri_lexicon",
    rf"""{_URIS}
select source, id, array_to_string(regexp_extract_all({sp.normalized(sp.decoded('uri'))},
  '{"|".join(sorted(LEXICON, key=lambda word: (-len(word), word)))}|[a-z0-9]+|[^\s]'), '|') as text from uris""",
)
def _uri_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uris(spark, sf_dir).select("source", "id", clean_uri(F.col("uri"), LEXICON).alias("text"))


@query(
    "uri_recent",
    rf"""
select {sp.cleaned(r"regexp_extract(uri, '\?(.*)')")} as uri, uri as uri_ori, epoch_s as date,
  srcip, dstip, md5({sp.HTTP_LINE}) as id
from fx_http
where marker <> 'other' and not {sp.STATIC} and contains(uri, '?')
  and epoch_s > {fx.NOW} - {DAYS} * 86400 and epoch_s < {fx.NOW}
""",
)
def _uri_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.http_lines(fx.events(spark, sf_dir)).where(is_http(F.col("value")))
    return recent_queries(http_flows(lines), fx.NOW, DAYS)


@query("uri_train_set", f"select label, {sp.cleaned('uri')} as uri from fx_http")
def _uri_train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(fx.http_columns(fx.events(spark, sf_dir)).select("label", "uri"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.syslog_lines(fx.events(spark, sf_dir))


def _patterns(spark: SparkSession) -> tuple[SyslogPattern, ...]:
    folder = work_folder(spark, "patterns")
    write_patterns(pattern_table(spark, VENDOR_PATTERNS), folder)
    return read_patterns(spark, folder)


@query("syslog_envelope", "select event_id, reportip, body as orglog from fx_syslog")
def _syslog_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(_lines(spark, sf_dir)).select(_line_id(), "reportip", "orglog")


@query(
    "syslog_classify",
    f"""
with lines as (select event_id, {sp.SYSLOG_LINE} as line from fx_syslog)
select event_id, {sp.pattern_id('line')} as logruleid from lines
""",
)
def _syslog_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_lines(spark, sf_dir), _patterns(spark)).select(_line_id(), "logruleid")


_PLAIN = [
    name
    for name in GENLOG_COLUMNS
    if name
    not in ("row", "recordid", "orglog", "logruleid", "orgid", "firstrecvtime", "eventname3")
]

GENLOG = f"""
lines as (select event_id, reportip, body, {sp.SYSLOG_LINE} as line from fx_syslog),
classified as (select *, {sp.pattern_id('line')} as logruleid from lines),
captured as (
  select event_id, reportip, body, line, logruleid, {sp.captured('line', 'firstrecvtime')} as time_text,
    {", ".join(f"coalesce({sp.captured('line', name)}, ' ') as {name}" for name in _PLAIN)}
  from classified where logruleid is not null),
genlog as (
  select *, 1000 * (case when time_text is null then {fx.NOW} else {sp.epoch_of_text('time_text')} end)
    as firstrecvtime, concat({sp.hashed('eventname')}, 'hashcode') as eventname3
  from captured)"""


@query(
    "syslog_genlog",
    f"""
with {GENLOG}
select event_id, reportip, body as orglog, logruleid, firstrecvtime, eventname3, {", ".join(_PLAIN)}
from genlog
""",
)
def _syslog_genlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = _patterns(spark)
    matched = classify(envelope(_lines(spark, sf_dir)), patterns)
    matched = matched.where(F.col("logruleid").isNotNull())
    return genlog_fields(matched, patterns, now=fx.NOW).select(
        _line_id(), "reportip", "orglog", "logruleid", "firstrecvtime", "eventname3", *_PLAIN
    )


SYSLOG_ROWS = f"""
with {GENLOG}
select 'syslog' as es_index, 'syslog' as es_type, md5(concat(line, '|syslog')) as recordid,
  'SYSLOG_LOG' as reportapp, reportip, ' ' as row, {fx.NOW * 1000} as recvtime,
  {fx.NOW * 1000} as storagetime, case when logruleid is null then 0 else 1 end as ismatch,
  line as logcontent, null as logruleid, null as orglog, null as orgid,
  {", ".join(f"null as {name}" for name in _PLAIN)},
  cast(null as bigint) as firstrecvtime, null as eventname3
from classified
union all by name
select 'genlog' as es_index, 'genlog' as es_type, md5(concat(line, '|genlog')) as recordid,
  'SYSLOG_LOG' as reportapp, reportip, ' ' as row, logruleid, body as orglog,
  md5(concat(line, '|syslog')) as orgid, firstrecvtime, eventname3, {", ".join(_PLAIN)}
from genlog
"""


@query("syslog_rows", SYSLOG_ROWS)
def _syslog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syslog_rows(_lines(spark, sf_dir), _patterns(spark), now=fx.NOW)


@query(
    "word_information",
    """
with spelled as (select doc_id, regexp_extract_all(text, '[A-Za-z]+') as words from documents where text is not null),
placed as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place from spelled),
moved as (select doc_id, word, place + unnest([-2, -1, 1, 2]) as place from placed),
pairs as (
  select placed.word, moved.word as context, count(*) as n
  from placed join moved using (doc_id, place) group by placed.word, moved.word),
sums as (select word, cast(sum(n) as double) as total from pairs group by word),
whole as (select cast(sum(n) as double) as whole from pairs),
weighed as (
  select pairs.word, pairs.n, pairs.n * whole / (a.total * b.total) as lift
  from pairs join sums as a on pairs.word = a.word join sums as b on pairs.context = b.word, whole)
select word, count(*) as contexts, cast(sum(floor(1000 * ln(lift))) as bigint) as information
from weighed where lift > 1 group by word
""",
)
def _word_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of words at most two places apart in the documents, and what they say of each other."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    texts = fx.table(spark, sf_dir, "documents").select(words.alias("words"))
    return word_information(texts, "words", 2)
