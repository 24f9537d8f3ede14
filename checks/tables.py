"""Features, sampling, class balance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql_parts as sp
from checks.registry import query
from flowvigil.operators.features import (
    GROUP_KEYS,
    attack_features,
    netflow_features,
    recent_netflow_features,
)
from flowvigil.operators.http import FLOW_COLUMNS, TAG_COLUMNS
from flowvigil.operators.netflow import netflow_records
from flowvigil.operators.partials import PartialStore
from flowvigil.operators.port_sets import merge_cells, port_cells, port_counts
from flowvigil.operators.sampling import (
    attack_training_set,
    hash_split,
    netflow_training_set,
    oversample,
    take_rows,
)
from flowvigil.plans.network import network_tables
from flowvigil.session import work_folder
from flowvigil.sources.sinks import Target, document_target
from flowvigil.sources.tables import flows_of, read_attack_csv, records_of
from flowvigil.sources.variants import document_keys, variant_columns, variant_documents

DAYS = 10
SAMPLE_ROWS = 100
SAMPLE_PERCENT = 5
KEY_HASH = "md5(concat_ws('|', srcip, proto, dstip, cast(recordtime as string)))"
BUCKET = f"cast('0x' || substring({KEY_HASH}, 1, 4) as bigint) % 100"
PLAIN = "exclude (srcports, dstports)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netflow_records(fx.netflow_lines(fx.events(spark, sf_dir)))


def attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.attack_columns(fx.table(spark, sf_dir, "lineitem"))


_FEATURES = sp.features("fx_netflow", "'normal'")


@query("netflow_features", f"select * {PLAIN} from ({_FEATURES})")
def _netflow_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netflow_features(records(spark, sf_dir), port_lists=False)


@query("netflow_ports", _FEATURES)
def _netflow_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netflow_features(records(spark, sf_dir))


@query(
    "netflow_recent_features",
    f"""
with recent as (select * from fx_netflow where recordtime > {fx.NOW} - {DAYS} * 86400)
{sp.features("recent", "'normal'")}
""",
)
def _netflow_recent_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_netflow_features(records(spark, sf_dir), fx.NOW, DAYS)


#: Batches in which the records of the partials arrive; the last brings late ones of all days.
BATCHES = 4


def _partial_store(spark: SparkSession, sf_dir: str) -> PartialStore:
    """Four batches of records, one of them run twice."""
    store = PartialStore(work_folder(spark, "partials"))
    for batch in (*range(BATCHES), 1):
        events = fx.events(spark, sf_dir).where(F.col("event_id") % BATCHES == batch)
        store.add(netflow_records(fx.netflow_lines(events)), batch)
    return store


@query(
    "netflow_partial_features",
    f"""
with recent as (select * from fx_netflow where recordtime > {fx.NOW} - {DAYS} * 86400)
{sp.features("recent", "'normal'")}
""",
)
def _netflow_partial_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partial_store(spark, sf_dir).features(spark, fx.NOW - DAYS * 86400)


@query("netflow_compacted_features", f"select * {PLAIN} from ({_FEATURES})")
def _netflow_compacted_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = PartialStore(work_folder(spark, "partials"))
    _partial_store(spark, sf_dir).compact(spark, merged)
    return merged.features(spark, lists=False)


@query(
    "netflow_port_rollup",
    """
with timed as (select srcip, starttime // 86400 as day, starttime // 604800 as week, srcport * 37 % 65536 as port from fx_netflow)
select 'day' as span, srcip, day as number, cast(count(distinct port) as double) as ports from timed group by srcip, day
union all
select 'week', srcip, week, cast(count(distinct port) as double) from timed group by srcip, week
union all
select 'all', null, null, cast(count(distinct port) as double) from timed
""",
)
def _netflow_port_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of days, rolled up to weeks and to one for all."""
    timed = records(spark, sf_dir).select(
        "srcip", F.floor(F.col("starttime") / 86400).alias("day"), (F.col("srcport").cast("int") * 37 % 65536).alias("port")
    )
    days = port_cells(timed, ["srcip", "day"], "port")
    week = F.floor((F.col("day")) / 7).alias("week")
    weeks = merge_cells(days, ["srcip", week])
    whole = merge_cells(weeks.withColumn("span", F.lit("all")), ["span"])
    return (
        port_counts(days, ["srcip", "day"], "ports")
        .select(F.lit("day").alias("span"), "srcip", F.col("day").alias("number"), "ports")
        .unionByName(
            port_counts(weeks, ["srcip", "week"], "ports")
            .select(F.lit("week").alias("span"), "srcip", F.col("week").alias("number"), "ports")
        )
        .unionByName(
            port_counts(whole, ["span"], "ports")
            .select("span", F.lit(None).cast("string").alias("srcip"), F.lit(None).cast("bigint").alias("number"), "ports")
        )
    )


@query(
    "netflow_sample",
    f"""
select * {PLAIN} from ({_FEATURES})
order by {KEY_HASH}, srcip, proto, dstip, recordtime limit {SAMPLE_ROWS}
""",
)
def _netflow_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = netflow_features(records(spark, sf_dir), port_lists=False)
    return take_rows(features, SAMPLE_ROWS, GROUP_KEYS)


def _attack_csv(spark: SparkSession, sf_dir: str, infer: bool = False) -> DataFrame:
    folder = work_folder(spark, "attack-csv")
    rows = attacks(spark, sf_dir)
    rows.write.option("header", True).csv(folder)
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return read_attack_csv(spark, folder, None if infer else schema)


_BY_LABEL = sp.attack_features("label", "srcip, proto, dstip, recordtime, label")
_AS_DOS = sp.attack_features("'DOS'", "srcip, proto, dstip, recordtime")


@query("attack_csv_features", _BY_LABEL)
def _attack_csv_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = attack_features(_attack_csv(spark, sf_dir), port_lists=False)
    return captured.withColumn("recordtime", F.col("recordtime").cast("bigint"))


@query("attack_csv_labelled", _AS_DOS)
def _attack_csv_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = attack_features(_attack_csv(spark, sf_dir, infer=True), "DOS", port_lists=False)
    return captured.withColumn("recordtime", F.col("recordtime").cast("bigint"))


_COPIES = """
sizes as (select label, count(*) as n from fx_attack group by label),
copies as (
  select label, false as by_flood, (select max(n) from sizes) // n as k from sizes
  union all
  select label, true, (select max(n) from sizes)
    // (case when label = 'PORTSCAN' then (select n from sizes where label = 'FLOOD') else n end)
  from sizes)"""


@query(
    "balance_classes",
    f"""
with {_COPIES},
balanced as (
  select by_flood, fx_attack.* from fx_attack join copies on fx_attack.label = copies.label,
    lateral (select unnest(generate_series(1, k))) as repeated)
select by_flood, label, recordtime, proto, count(*) as n, cast(sum(packernum) as bigint) as packets,
  cast(sum(bytesize) as bigint) as bytes, count(distinct srcport) as ports
from balanced group by by_flood, label, recordtime, proto
""",
)
def _balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attacks(spark, sf_dir)
    both = (
        oversample(rows)
        .withColumn("by_flood", F.lit(False))
        .unionByName(oversample(rows, portscan_by_flood=True).withColumn("by_flood", F.lit(True)))
    )
    return both.groupBy("by_flood", "label", "recordtime", "proto").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("packernum").alias("packets"),
        F.sum("bytesize").alias("bytes"),
        F.count_distinct("srcport").alias("ports"),
    )


@query(
    "balance_many_classes",
    """
with labelled as (
  select case when l_partkey % 2000 = 0 then null else concat('c', l_partkey % 2000) end as label, l_orderkey, l_linenumber
  from lineitem),
sizes as (select label, count(*) as n from labelled group by label)
select label, cast(n * ((select max(n) from sizes) // n) as bigint) as n from sizes
""",
)
def _balance_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by the thousand, one of them null."""
    part = F.col("l_partkey") % 2000
    rows = fx.table(spark, sf_dir, "lineitem").select(
        F.when(part != 0, F.concat(F.lit("c"), part.cast("string"))).alias("label"), "l_orderkey", "l_linenumber"
    )
    return oversample(rows).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "netflow_train_set",
    f"""
select * from ({_BY_LABEL}) where label in ('DOS', 'PORTSCAN')
union all by name
select * {PLAIN} from ({_FEATURES}) where {BUCKET} < {SAMPLE_PERCENT}
""",
)
def _netflow_train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = attack_features(attacks(spark, sf_dir), port_lists=False)
    parts = [captured.where(F.col("label") == label) for label in ("DOS", "PORTSCAN")]
    normal = netflow_features(records(spark, sf_dir), port_lists=False)
    return netflow_training_set(parts, normal, SAMPLE_PERCENT, GROUP_KEYS)


def _stored(spark: SparkSession, attack: DataFrame, normal: DataFrame) -> list[DataFrame]:
    """Feature tables as training sets want them, which read them more than once."""
    tables = []
    for name, df in (("attack", attack), ("normal", normal)):
        folder = work_folder(spark, f"features-{name}")
        Target("parquet", folder).write(df)
        tables.append(spark.read.parquet(folder))
    return tables


@query(
    "attack_train_set",
    f"""
with attack as ({_BY_LABEL}),
sizes as (select label, count(*) as n from attack group by label),
copies as (select label, (select max(n) from sizes) // n as k from sizes),
balanced as (
  select attack.* from attack join copies on attack.label = copies.label,
    lateral (select unnest(generate_series(1, k))) as repeated),
normal as (
  select * {PLAIN} from ({_FEATURES})
  order by {KEY_HASH}, srcip, proto, dstip, recordtime
  limit (select 5 * count(*) from balanced))
select * from balanced union all by name select * from normal
""",
)
def _attack_train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = attack_features(attacks(spark, sf_dir), port_lists=False)
    normal = netflow_features(records(spark, sf_dir), port_lists=False)
    return attack_training_set(*_stored(spark, captured, normal), GROUP_KEYS)


@query(
    "attack_train_set_bounded",
    f"""
with placed as (
  select *, row_number() over (
    partition by label, proto order by bytesize desc, srcip desc, dstip desc, recordtime desc) as place
  from ({_BY_LABEL})),
attack as (select * exclude (place) from placed where place = 1),
sizes as (select label, count(*) as n from attack group by label),
copies as (select label, (select max(n) from sizes) // n as k from sizes),
balanced as (
  select attack.* from attack join copies on attack.label = copies.label,
    lateral (select unnest(generate_series(1, k))) as repeated),
normal as (
  select * {PLAIN} from ({_FEATURES})
  order by {KEY_HASH}, srcip, proto, dstip, recordtime
  limit (select 5 * count(*) from balanced))
select * from balanced union all by name select * from normal
""",
)
def _attack_train_set_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest capture of each label and protocol: fewer attacks than a fifth of the normal rows."""
    captured = attack_features(attacks(spark, sf_dir), port_lists=False)
    order = F.struct("bytesize", "srcip", "dstip", "recordtime")
    largest = captured.groupBy("label", "proto").agg(F.max_by(F.struct(*captured.columns), order).alias("row"))
    normal = netflow_features(records(spark, sf_dir), port_lists=False)
    return attack_training_set(*_stored(spark, largest.select("row.*"), normal), GROUP_KEYS)


@query(
    "sample_split",
    f"""
select srcip, proto, dstip, recordtime, {BUCKET} < {SAMPLE_PERCENT} as in_sample
from fx_netflow group by srcip, proto, dstip, recordtime
""",
)
def _sample_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = netflow_features(records(spark, sf_dir), port_lists=False)
    return hash_split(features, SAMPLE_PERCENT, GROUP_KEYS).select(*GROUP_KEYS, "in_sample")


@query("features_roundtrip", _FEATURES)
def _features_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "features")
    Target("parquet", folder).write(netflow_features(records(spark, sf_dir)))
    return spark.read.parquet(folder)


def _stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of flow and netflow lines, written and read again."""
    source = fx.events(spark, sf_dir)
    lines = fx.http_lines(source).unionByName(fx.netflow_lines(source))
    folder = work_folder(spark, "stored")
    document_target(folder).write(network_tables(lines, fx.rules(spark)).documents())
    return spark.read.parquet(folder)


@query("stored_features", _FEATURES)
def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netflow_features(records_of(_stored_documents(spark, sf_dir)))


@query(
    "stored_documents",
    f"""
with {sp.RULE_MATCH}
select 'flow' as es_index, event_id, srcip, dstip, epoch_s as at, uri, 'GET' as detail from matched
union all
select 'netflow', event_id, srcip, dstip, starttime, null, 'http' from fx_netflow
""",
)
def _stored_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_documents(spark, sf_dir)
    sequence = F.col("extra")["seq"].cast("bigint").alias("event_id")
    flows = flows_of(stored).select(
        F.lit("flow").alias("es_index"), sequence, "srcip", "dstip", F.col("date").alias("at"), "uri",
        F.col("method").alias("detail"),
    )
    found = records_of(stored).select(
        F.lit("netflow").alias("es_index"), sequence, "srcip", "dstip", F.col("starttime").alias("at"),
        F.lit(None).cast("string").alias("uri"), F.col("proto7").alias("detail"),
    )
    return flows.unionByName(found)


#: Keys that are no text, and those that only some documents have.
_KEY_TYPES = {"date": "BIGINT", "flowcontent": "OBJECT<Date: STRING, DstIp: STRING, Method: STRING, Seq: STRING, SrcIp: STRING, Uri: STRING>"}
_NETFLOW_NUMBERS = ("downpkts", "downs", "lasttime", "recordtime", "starttime", "ups", "uppkts", "packernum")
_NETFLOW_TEXTS = ("dstip", "dstport", "proto", "proto7", "recordid", "srcip", "srcport", "seq")


def _key_counts() -> str:
    """Counts of documents that have a key, for each key of each kind of document."""
    flow = {key: _KEY_TYPES.get(key, "STRING") for key in (*FLOW_COLUMNS, *TAG_COLUMNS, "flowcontent", "seq")}
    netflow = dict.fromkeys(_NETFLOW_NUMBERS, "BIGINT") | dict.fromkeys((*_NETFLOW_TEXTS, "es_type", "es_index"), "STRING")
    of = {
        "flow": (flow, "matched"),
        "flowlogrule": (flow | {"ruleid": "STRING"}, "matched where ruleid is not null"),
        "netflow": (netflow, "fx_netflow"),
    }
    some = {"uppkts": "uppkts", "packernum": "uppkts + downpkts"}
    return " union all ".join(
        f"select '{index}' as es_index, '{key}' as key, '{kind}' as type, count({some.get(key, '*')}) as n from {rows}"
        for index, (keys, rows) in of.items()
        for key, kind in sorted(keys.items())
    )


@query("stored_keys", f"with {sp.RULE_MATCH} {_key_counts()}")
def _stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key of the stored documents, by the type of its value."""
    return document_keys(variant_documents(_stored_documents(spark, sf_dir)), "es_index")


@query(
    "stored_variants",
    f"""
with {sp.RULE_MATCH}
select 'flow' as es_index, event_id, srcip, dstip, epoch_s as at, uri, 'GET' as detail, null as packets from matched
union all
select 'netflow', event_id, srcip, dstip, starttime, null, 'http', uppkts + downpkts from fx_netflow
""",
)
def _stored_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of two kinds of documents, read from variants."""
    wanted = {
        "seq": "bigint", "srcip": "string", "dstip": "string", "date": "bigint", "starttime": "bigint",
        "uri": "string", "method": "string", "proto7": "string", "packernum": "bigint",
    }
    parsed = variant_documents(_stored_documents(spark, sf_dir)).where(F.col("es_index").isin("flow", "netflow"))
    return parsed.select("es_index", *variant_columns(wanted)).select(
        "es_index", F.col("seq").alias("event_id"), "srcip", "dstip", F.coalesce("date", "starttime").alias("at"), "uri",
        F.coalesce("method", "proto7").alias("detail"), F.col("packernum").alias("packets"),
    )
