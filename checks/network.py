"""Routing, HTTP flows, rules, netflow records and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql_parts as sp
from checks.registry import query
from flowvigil.operators.deadletter import dead_letters, network_errors, syslog_errors
from flowvigil.operators.http import FLOW_COLUMNS, complete, drop_static, http_flows, parse_http
from flowvigil.operators.netflow import (
    explode_records,
    netflow_messages,
    netflow_records,
    typed_records,
)
from flowvigil.operators.netflow_messages import (
    json_messages,
    parse_json_messages,
    parse_text_messages,
    text_messages,
)
from flowvigil.operators.route import is_http, route
from flowvigil.operators.rule_versions import dated_rules
from flowvigil.operators.rules import match_rules, rule_rows
from flowvigil.operators.uri_flows import flow_messages, parse_flow_messages
from flowvigil.plans.network import network_tables
from flowvigil.session import work_folder
from flowvigil.sources.sinks import document_target, rule_hits


def _event_id() -> Column:
    return F.col("extra")["seq"].cast("bigint").alias("event_id")



def _http(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.http_lines(fx.events(spark, sf_dir)).where(is_http(F.col("value")))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_rules(http_flows(_http(spark, sf_dir)), fx.rules(spark))


@query(
    "route",
    """
with kinds as (
  select 'http' as kind, case when marker = 'other' then 'netflow' else 'http' end as route
  from fx_http
  union all select unnest(['netflow', 'syslog', 'idle']), 'netflow' from events)
select kind, route, count(*) as lines from kinds group by kind, route
""",
)
def _route(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.events(spark, sf_dir)
    kinds = {
        "http": fx.http_lines,
        "netflow": fx.netflow_lines,
        "syslog": fx.syslog_lines,
        "idle": fx.noise_lines,
    }
    lines = None
    for kind, derive in kinds.items():
        part = derive(source).withColumn("kind", F.lit(kind))
        lines = part if lines is None else lines.unionByName(part)
    return route(lines).groupBy("kind", "route").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "http_parse",
    """
select event_id, uri, srcip, dstip, 'Date,DstIp,Method,Seq,SrcIp,Uri' as keys,
  strftime(make_timestamp(epoch_s * 1000000), '%Y-%m-%d %H:%M:%S') as date
from fx_http where marker <> 'other'
""",
)
def _http_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("flowcontent")
    return parse_http(_http(spark, sf_dir)).select(
        content["Seq"].cast("bigint").alias("event_id"),
        content["Uri"].alias("uri"),
        content["SrcIp"].alias("srcip"),
        content["DstIp"].alias("dstip"),
        F.array_join(F.array_sort(F.map_keys(content)), ",").alias("keys"),
        content["Date"].alias("date"),
    )


@query(
    "http_filter",
    f"select event_id, uri from fx_http where marker <> 'other' and not {sp.STATIC}",
)
def _http_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("flowcontent")
    return drop_static(parse_http(_http(spark, sf_dir))).select(
        content["Seq"].cast("bigint").alias("event_id"), content["Uri"].alias("uri")
    )


_GIVEN = {
    "method": "'GET'",
    "uri": "uri",
    "srcip": "srcip",
    "dstip": "dstip",
    "date": "epoch_s",
}


@query(
    "http_complete",
    f"""
select event_id, md5({sp.HTTP_LINE}) as id, 'flow' as es_type, 'flow' as es_index,
  'seq' as extra_keys,
  {", ".join(f'{_GIVEN.get(name, "' '")} as {name}' for name in FLOW_COLUMNS)}
from fx_http where marker <> 'other' and not {sp.STATIC}
""",
)
def _http_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = complete(drop_static(parse_http(_http(spark, sf_dir))))
    extra_keys = F.array_join(F.map_keys("extra"), ",").alias("extra_keys")
    return flows.select(_event_id(), "id", "es_type", "es_index", extra_keys, *FLOW_COLUMNS)


@query("http_rule_match", f"with {sp.RULE_MATCH} select event_id, uri, ruleid from matched")
def _http_rule_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select(_event_id(), "uri", "ruleid")


@query(
    "http_many_rules",
    f"""
with numbers as (
  select distinct cast(substr(p_brand, 7) as bigint) * 100 + p_size as number from part),
flows as (select event_id from fx_http where marker <> 'other' and not {sp.STATIC})
select event_id, case when number is not null then concat('part', number) end as ruleid
from flows left join numbers on event_id % 8 = 5 and event_id = number
""",
)
def _http_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each brand and size of the parts, behind one that does not compile."""
    number = F.substring("p_brand", 7, 9).cast("bigint") * 100 + F.col("p_size")
    good = fx.table(spark, sf_dir, "part").select(number.alias("rule_pos")).distinct()
    text = F.col("rule_pos").cast("string")
    rules = good.select(
        "rule_pos", F.concat(F.lit("part"), text).alias("ruleid"), F.lit("any").alias("sourceip"),
        F.lit("any").alias("destip"), F.concat(F.lit(r"/item\?id="), text, F.lit("&")).alias("rule_regular_expression"),
    )
    broken = fx.rules(spark).limit(1).select(
        F.lit(-1).cast("bigint").alias("rule_pos"), F.lit("broken").alias("ruleid"), "sourceip", "destip",
        F.lit("item(").alias("rule_regular_expression"),
    )
    matched = match_rules(http_flows(_http(spark, sf_dir)), rules.unionByName(broken))
    return matched.select(_event_id(), "ruleid")


#: Rules of the index query: five numbers for each of so many parts, two rules a number.
INDEXED_PARTS = 1000


@query(
    "http_rule_index",
    f"""
with numbers as (
  select distinct p_partkey % {INDEXED_PARTS} * 5 + k as number from part, range(5) as r(k)),
flows as (select event_id, user_id from fx_http join events using (event_id) where marker <> 'other' and not {sp.STATIC})
select event_id, case
  when number is not null and user_id % 8 = 3 then concat('from3-', number)
  when number is not null then concat('item', number)
  when event_id % 8 = 7 then 'comma' end as ruleid
from flows left join numbers on event_id % 8 = 5 and event_id = number
""",
)
def _http_rule_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten thousand rules, filed by literals, and one without any."""
    part = fx.table(spark, sf_dir, "part").select((F.col("p_partkey") % INDEXED_PARTS).alias("part")).distinct()
    five = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.col("part") * 5 + k)
    numbers = part.select(F.explode(five).alias("number"))
    text = F.col("number").cast("string")
    kinds = {
        "from3-": (F.lit("10.0.0.3"), F.concat(F.lit(r"/item\?id="), text, F.lit("&name=(foo|bar)"))),
        "item": (F.lit("any"), F.concat(F.lit("id="), text, F.lit(r"&name=foo\s+bar$"))),
    }
    rules = None
    for position, (name, (source, pattern)) in enumerate(kinds.items()):
        one = numbers.select(
            (F.col("number") * 2 + position).alias("rule_pos"), F.concat(F.lit(name), text).alias("ruleid"),
            source.alias("sourceip"), F.lit("any").alias("destip"), pattern.alias("rule_regular_expression"),
        )
        rules = one if rules is None else rules.unionByName(one)
    comma = fx.rules(spark).limit(1).select(
        F.lit(1 << 40).alias("rule_pos"), F.lit("comma").alias("ruleid"), "sourceip", "destip",
        F.lit("[?].*,").alias("rule_regular_expression"),
    )
    matched = match_rules(http_flows(_http(spark, sf_dir)), rules.unionByName(comma), ip_match="strict")
    return matched.select(_event_id(), "ruleid")


#: A version of a priority's rule begins so many seconds after the one before it.
VERSION_STEP = 40_000
VERSIONS_FROM = 1_704_067_200


@query(
    "http_rule_versions",
    f"""
with versions as (
  select o_orderpriority as ruleid, cast(substr(o_orderpriority, 1, 1) as bigint) as rule_pos, count(*) as n,
    {VERSIONS_FROM} + ((month(o_orderdate) - 1) * 5 + cast(substr(o_orderpriority, 1, 1) as bigint)) * {VERSION_STEP} as valid_from
  from orders group by o_orderpriority, month(o_orderdate)),
flows as (select event_id, epoch_s, event_id % 8 = 5 as item from fx_http where marker <> 'other' and not {sp.STATIC}),
named as (select event_id, epoch_s, item, ruleid, rule_pos from flows, (select distinct ruleid, rule_pos from versions)),
dated as (
  select named.event_id, named.item, named.ruleid, named.rule_pos, n
  from named asof left join versions on named.ruleid = versions.ruleid and named.epoch_s >= versions.valid_from)
select event_id, arg_min(ruleid, rule_pos) filter (
  item and n % 7 <> 0 and event_id % 10 in (n % 10, (n + 1) % 10)) as ruleid
from dated group by event_id
""",
)
def _http_rule_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each priority, which the orders of each month change or withdraw."""
    priority = F.substring("o_orderpriority", 1, 1).cast("bigint")
    counted = fx.table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("ruleid"), priority.alias("rule_pos"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))
    digits = [(F.col("n") + k) % 10 for k in (0, 1)]
    pattern = F.concat(F.lit(r"/item\?id=[0-9]*["), *digits, F.lit("]&"))
    versions = counted.select(
        "ruleid", "rule_pos", F.lit("any").alias("sourceip"), F.lit("any").alias("destip"),
        F.when(F.col("n") % 7 != 0, pattern).alias("rule_regular_expression"),
        (((F.col("month") - 1) * 5 + F.col("rule_pos")) * VERSION_STEP + VERSIONS_FROM).alias("valid_from"),
    )
    matched = match_rules(http_flows(_http(spark, sf_dir)), dated_rules(versions))
    return matched.select(_event_id(), "ruleid")


@query(
    "http_rule_rows",
    f"""
with {sp.RULE_MATCH}
select event_id, 'flow' as es_type, 'flow' as es_index, null as ruleid from matched
union all
select event_id, 'flowlogrule', 'flowlogrule', ruleid from matched where ruleid is not null
""",
)
def _http_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_rows(_matched(spark, sf_dir)).select(_event_id(), "es_type", "es_index", "ruleid")


@query(
    "rule_hits",
    f"""
with {sp.RULE_MATCH}
select ruleid, make_timestamp({fx.NOW * 1000000}) as rule_time,
  make_timestamp(epoch_s * 1000000) as match_time
from matched where ruleid is not null
""",
)
def _rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _matched(spark, sf_dir).where(F.col("ruleid").isNotNull())
    timed = hits.select("ruleid", F.lit(fx.NOW).alias("rule_time"), F.col("date").alias("match_time"))
    as_utc = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("rule_time", "match_time")]
    return rule_hits(timed).select("ruleid", *as_utc)


@query(
    "netflow_parse",
    """
select event_id, srcip, dstip, cast(srcport as string) as srcport,
  cast(dstport as string) as dstport, proto, 'http' as proto7, starttime, lasttime, recordtime,
  ups, downs, uppkts, downpkts, uppkts + downpkts as packernum,
  'netflow' as es_type, 'netflow' as es_index
from fx_netflow
""",
)
def _netflow_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.events(spark, sf_dir)
    lines = fx.grouped_netflow_lines(source).unionByName(fx.noise_lines(source))
    rows = explode_records(netflow_messages(lines))
    event_id = F.col("record")["seq"].cast("bigint")
    return typed_records(rows.withColumn("event_id", event_id), ["event_id"]).drop("recordid", "extra")


_MESSAGES = f"""
{sp.RULE_MATCH},
messages as (
  select event_id, uri, srcip, dstip, epoch_s, md5(line) as id,
    concat('id=', md5(line), ',uri=', uri, ',dstip=', dstip, ',srcip=', srcip, ',date=', epoch_s)
      as value
  from matched, range(2) as copies(copy) where copy = 0 or ruleid is not null)"""


_LAST_QUERY = r"regexp_extract(uri, '.*\?(.*)', 1)"


@query("flow_message", f"with {_MESSAGES} select value from messages")
def _flow_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_messages(rule_rows(_matched(spark, sf_dir))).select("value")


@query(
    "flow_message_parse",
    f"""
with {_MESSAGES}
select id, {sp.cleaned(_LAST_QUERY)} as uri,
  regexp_extract(uri, '^[^,]*') as uri_ori, epoch_s as date, srcip, dstip
from messages where contains(uri, '?')
""",
)
def _flow_message_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = flow_messages(rule_rows(_matched(spark, sf_dir)))
    return parse_flow_messages(fx.as_lines(messages, F.col("value")))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netflow_records(fx.netflow_lines(fx.events(spark, sf_dir)))


_RECORD = f"""
select cast(downpkts as double) as downpkts, cast(uppkts + downpkts as double) as packernum, srcip,
  cast(lasttime as double) as lasttime, proto, cast(recordtime as double) as recordtime,
  md5(concat({sp.NETFLOW_LINE}, '|0')) as recordid, cast(starttime as double) as starttime,
  cast(srcport as string) as srcport, dstip, cast(ups as double) as ups,
  cast(uppkts as double) as uppkts, cast(dstport as string) as dstport,
  cast(downs as double) as downs
from fx_netflow"""


@query("netflow_message", f"{_RECORD} where uppkts is not null")
def _netflow_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fx.as_lines(text_messages(_records(spark, sf_dir)), F.col("value"))
    return parse_text_messages(messages).drop("netflow")


@query("netflow_message_json", _RECORD)
def _netflow_message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fx.as_lines(json_messages(_records(spark, sf_dir)), F.col("value"))
    return parse_json_messages(messages)


@query(
    "route_sink",
    f"""
with {sp.RULE_MATCH},
rows as (
  select 'flow' as es_index, md5(line) as id from matched
  union all select 'flowlogrule', md5(line) from matched where ruleid is not null
  union all select 'netflow', md5(concat({sp.NETFLOW_LINE}, '|0')) from fx_netflow)
select es_index, es_index as es_type, count(*) as documents, count(distinct id) as ids,
  min(id) as first_id, max(id) as last_id
from rows group by es_index
""",
)
def _route_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.events(spark, sf_dir)
    lines = fx.http_lines(source).unionByName(fx.netflow_lines(source))
    documents = network_tables(lines, fx.rules(spark)).documents()
    folder = work_folder(spark, "documents")
    document_target(folder).write(documents)
    stored = spark.read.parquet(folder)
    return stored.groupBy("es_index", "es_type").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query(
    "dead_letter",
    """
select 'network' as stage, 'http payload is no JSON object' as error, count(*) as letters,
  count(distinct event_id) as events from events
union all
select 'syslog', 'syslog line has fewer than thirty fields', count(*), count(distinct event_id)
from events
""",
)
def _dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.events(spark, sf_dir)
    network = fx.http_lines(source).unionByName(fx.netflow_lines(source))
    network = network.unionByName(fx.broken_lines(source))
    short = source.select(F.concat("event_id", F.lit("|!short|!|!")).alias("value"))
    syslog = fx.syslog_lines(source).unionByName(short)
    letters = dead_letters(network_errors(network), "network").unionByName(
        dead_letters(syslog_errors(syslog), "syslog")
    )
    event_id = F.regexp_extract("log", r'^(?:netlog_http .*"Seq":)?(\d+)', 1)
    return letters.groupBy("stage", "error").agg(
        F.count(F.lit(1)).alias("letters"), F.count_distinct(event_id).alias("events")
    )
