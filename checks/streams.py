"""The same work on streams: files in, everything available, files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql_parts as sp
from checks.models import SQL_LABEL, netflow_model, scoring_model, scoring_model_path, union_model_path
from checks.registry import query
from checks.texts import SYSLOG_ROWS
from flowvigil.operators.features import netflow_features
from flowvigil.operators.netflow import netflow_records
from flowvigil.operators.netflow_messages import json_messages
from flowvigil.operators.route import is_http
from flowvigil.operators.http import http_flows
from flowvigil.operators.uri_flows import flow_messages
from flowvigil.plans.models import ModelFeed
from flowvigil.session import work_folder
from flowvigil.sources.patterns import VENDOR_PATTERNS
from flowvigil.sources.sinks import DESTINATION, Target
from flowvigil.sources.tables import spread
from flowvigil.streaming.network import start_network_etl
from flowvigil.streaming.run import StreamOptions, state_partitions
from flowvigil.streaming.scoring import (
    start_netflow_scoring,
    start_uri_scoring,
    start_window_scoring,
)
from flowvigil.streaming.syslog import start_syslog_etl
from flowvigil.streaming.windows import session_features, windowed_features


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    return _on_all_cores(
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def _on_all_cores(source: DataFrame) -> DataFrame:
    """A file of few row groups is read by as few tasks; what makes lines of it and parses them gets more."""
    return spread(source, source.sparkSession.sparkContext.defaultParallelism)


def _state(spark: SparkSession) -> int:
    """Partitions of a stream's state: a few for each core."""
    return 2 * spark.sparkContext.defaultParallelism


def _options(spark: SparkSession, **changes) -> StreamOptions:
    return StreamOptions(work_folder(spark, "stream-checkpoint"), interval=None, **changes)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events before the middle of their time, and the others."""
    events = fx.table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = F.lit(ends["first"] + (ends["last"] - ends["first"]) / 2)
    return events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)


#: Where the halves part, in SQL: microseconds since the epoch.
_MIDDLE = "(select epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2 from events)"


def _target(spark: SparkSession, purpose: str, *partition_by: str) -> Target:
    return Target("parquet", work_folder(spark, purpose), partition_by=partition_by)


def _written(spark: SparkSession, target: Target) -> DataFrame:
    return spark.read.parquet(target.location).drop("stream_id", "batch_id")


@query(
    "stream_route",
    f"""
with {sp.RULE_MATCH},
rows as (
  select 'documents' as output, 'flow' as destination, md5(line) as id from matched
  union all
  select 'documents', 'flowlogrule', md5(line) from matched where ruleid is not null
  union all select 'documents', 'netflow', md5(concat({sp.NETFLOW_LINE}, '|0')) from fx_netflow
  union all select 'flow_messages', 'flow', null from matched
  union all select 'flow_messages', 'flow', null from matched where ruleid is not null
  union all select 'netflow_messages', 'netflow', null from fx_netflow
  union all select 'letters', 'letters', null from events)
select output, destination, count(*) as n, count(distinct id) as ids, max(id) as last_id
from rows group by output, destination
""",
)
def _stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = event_stream(spark, sf_dir)
    lines = fx.http_lines(source)
    for part in (fx.netflow_lines, fx.noise_lines, fx.broken_lines):
        lines = lines.unionByName(part(source))
    targets = {
        "documents": _target(spark, "documents", *DESTINATION),
        "flow_messages": _target(spark, "flow-messages"),
        "netflow_messages": _target(spark, "netflow-messages"),
        "letters": _target(spark, "letters"),
    }
    start_network_etl(lines, fx.rules(spark), targets, _options(spark)).awaitTermination()
    no_id = F.lit(None).cast("string")
    outputs = {
        "documents": (F.col("es_index"), F.col("id")),
        "flow_messages": (F.lit("flow"), no_id),
        "netflow_messages": (F.lit("netflow"), no_id),
        "letters": (F.lit("letters"), no_id),
    }
    rows = None
    for name, (destination, row_id) in outputs.items():
        part = _written(spark, targets[name]).select(
            F.lit(name).alias("output"), destination.alias("destination"), row_id.alias("id")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("output", "destination").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("ids"),
        F.max("id").alias("last_id"),
    )


@query("stream_syslog", SYSLOG_ROWS)
def _stream_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.syslog_lines(event_stream(spark, sf_dir))
    rows = _target(spark, "syslog-rows")
    start_syslog_etl(
        lines,
        VENDOR_PATTERNS,
        {"rows": rows},
        _options(spark, partitions=spark.sparkContext.defaultParallelism),
        now=fx.NOW,
    ).awaitTermination()
    return _written(spark, rows)


_FEATURES = sp.features("fx_netflow", "'normal'")


@query("stream_netflow_batch", f"select * exclude (srcports, dstports) from ({_FEATURES})")
def _stream_netflow_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "batch-features")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        target.write_batch(netflow_features(netflow_records(batch), port_lists=False), batch_id)

    lines = fx.netflow_lines(event_stream(spark, sf_dir))
    _options(spark).start(lines, each_batch).awaitTermination()
    return _written(spark, target)


@query(
    "stream_netflow_alerts",
    f"""
with groups as ({sp.features("fx_netflow", SQL_LABEL)})
select label as attacktype, proto, count(*) as alerts, cast(sum(srcport) as bigint) as srcports,
  cast(sum(dstport) as bigint) as dstports, sum(spandtime * 1000) as costtime
from fx_netflow join (select * exclude (srcports, dstports) from groups) as g
  using (srcip, proto, dstip, recordtime)
where label <> 'normal' group by label, proto
""",
)
def _stream_netflow_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = json_messages(netflow_records(fx.netflow_lines(event_stream(spark, sf_dir))))
    target = _target(spark, "netflow-alerts")
    start_netflow_scoring(
        messages, netflow_model(spark, sf_dir), target, _options(spark)
    ).awaitTermination()
    return (
        _written(spark, target)
        .groupBy("attacktype", "proto")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.sum("srcport").alias("srcports"),
            F.sum("dstport").alias("dstports"),
            F.sum("costtime").alias("costtime"),
        )
    )


@query(
    "stream_uri_score",
    f"""
select concat('ignore', md5({sp.HTTP_LINE})) as id, make_timestamp(epoch_s * 1000000) as date,
  srcip, dstip, uri, 1.0e0 as predictionnb, uri as url
from fx_http where marker <> 'other' and label = 'sql'
""",
)
def _stream_uri_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.http_lines(event_stream(spark, sf_dir)).where(is_http(F.col("value")))
    target = _target(spark, "uri-alerts")
    start_uri_scoring(
        flow_messages(http_flows(lines)), scoring_model(spark, sf_dir), target, _options(spark)
    ).awaitTermination()
    return _written(spark, target).select(
        "id",
        F.col("date").cast("timestamp_ntz").alias("date"),
        "srcip",
        "dstip",
        "uri",
        "predictionnb",
        "url",
    )


WIDTH, DELAY = "1 day", "1 day"


@query(
    "stream_netflow_window",
    """
with windows as (
  select *, starttime - starttime % 86400 as day from fx_netflow),
closed as (select max(epoch_ms(ts)) - 86400000 as watermark from events)
select make_timestamp(day * 1000000) as window_start,
  make_timestamp((day + 86400) * 1000000) as window_end, srcip, dstip, proto,
  cast(sum(lasttime - starttime) as double) as spandtime,
  cast(sum(uppkts + downpkts) as double) as packernum,
  cast(sum(ups + downs) as double) as bytesize,
  cast(count(distinct srcport) as double) as src_flow_port_num,
  cast(count(distinct dstport) as double) as dst_flow_port_num,
  case when proto in ('tcp', 'TCP') then 1.0e0 else 0.0e0 end as tcp,
  case when proto in ('udp', 'UDP') then 1.0e0 else 0.0e0 end as udp,
  cast(count(*) as double) as flownum
from windows, closed where (day + 86400) * 1000 <= watermark
group by day, srcip, dstip, proto
""",
)
def _stream_netflow_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = netflow_records(fx.netflow_lines(event_stream(spark, sf_dir)))
    timed = records.withColumn("event_time", F.timestamp_seconds("starttime"))
    windows = windowed_features(timed, "event_time", WIDTH, DELAY)
    target = work_folder(spark, "windows")
    writer = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", work_folder(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
    )
    with state_partitions(spark, _state(spark)):
        running = writer.start(target)
    running.awaitTermination()
    bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    written = spark.read.parquet(target)
    return written.select(*bounds, *[c for c in written.columns if not c.startswith("window_")])


@query(
    "stream_window_alerts",
    f"""
with windows as (
  select *, starttime - starttime % 86400 as day from fx_netflow),
closed as (select max(epoch_ms(to_timestamp(starttime))) - 86400000 as watermark from fx_netflow)
select make_timestamp(day * 1000000) as window_start, srcip, dstip, proto, {SQL_LABEL} as attacktype,
  cast(sum(lasttime - starttime) as double) as spandtime, cast(count(*) as double) as flownum
from windows, closed where (day + 86400) * 1000 <= watermark and {SQL_LABEL} <> 'normal'
group by day, srcip, dstip, proto
""",
)
def _stream_window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = json_messages(netflow_records(fx.netflow_lines(event_stream(spark, sf_dir))))
    target, options = _target(spark, "window-alerts"), _options(spark, state=_state(spark))
    start_window_scoring(
        messages, netflow_model(spark, sf_dir), target, options, WIDTH, DELAY
    ).awaitTermination()
    return _written(spark, target).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "srcip", "dstip", "proto", "attacktype", "spandtime", "flownum",
    )


#: A pause in seconds that ends a session, and how late a record may come.
PAUSE, LATE = 8 * 3600, 3600


@query(
    "stream_netflow_sessions",
    f"""
with placed as (
  select *, lag(starttime) over conversation as before from fx_netflow
  window conversation as (partition by srcip, dstip, proto order by starttime, event_id)),
numbered as (
  select *, count(*) filter (before is null or starttime - before > {PAUSE}) over (
    partition by srcip, dstip, proto order by starttime, event_id rows unbounded preceding) as session
  from placed),
closed as (select max(starttime) - {LATE} as watermark from fx_netflow)
select make_timestamp(min(starttime) * 1000000) as window_start,
  make_timestamp((max(starttime) + {PAUSE}) * 1000000) as window_end, srcip, dstip, proto,
  cast(sum(lasttime - starttime) as double) as spandtime,
  cast(sum(uppkts + downpkts) as double) as packernum,
  cast(sum(ups + downs) as double) as bytesize,
  cast(count(distinct srcport) as double) as src_flow_port_num,
  cast(count(distinct dstport) as double) as dst_flow_port_num,
  case when proto in ('tcp', 'TCP') then 1.0e0 else 0.0e0 end as tcp,
  case when proto in ('udp', 'UDP') then 1.0e0 else 0.0e0 end as udp,
  cast(count(*) as double) as flownum
from numbered group by srcip, dstip, proto, session
having max(starttime) + {PAUSE} <= (select watermark from closed)
""",
)
def _stream_netflow_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events, then, after a restart, the other half: sessions that are open in between go on."""
    feed, target = work_folder(spark, "event-feed"), work_folder(spark, "sessions")
    checkpoint = work_folder(spark, "stream-checkpoint")
    for half in _halves(spark, sf_dir):
        half.write.mode("append").parquet(feed)
        source = _on_all_cores(spark.readStream.schema(half.schema).parquet(feed))
        records = netflow_records(fx.netflow_lines(source))
        timed = records.withColumn("event_time", F.timestamp_seconds("starttime"))
        sessions = session_features(timed, "event_time", f"{PAUSE} seconds", f"{LATE} seconds")
        writer = (
            sessions.writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
        )
        with state_partitions(spark, _state(spark)):
            running = writer.start(target)
        running.awaitTermination()
    written = spark.read.parquet(target)
    bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return written.select(*bounds, *[c for c in written.columns if not c.startswith("window_")])


def _flow_feed(spark: SparkSession, folder: str, events: DataFrame) -> DataFrame:
    """Flow messages of the events that are in the folder, these added to them."""
    events.write.mode("append").parquet(folder)
    source = _on_all_cores(spark.readStream.schema(events.schema).parquet(folder))
    return flow_messages(http_flows(fx.http_lines(source).where(is_http(F.col("value")))))


@query(
    "stream_alerts_once",
    f"""
select srcip, dstip, uri, count(*) as alerts, count(distinct md5({sp.HTTP_LINE})) as ids
from fx_http where marker <> 'other' and label = 'sql' group by srcip, dstip, uri
""",
)
def _stream_alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the events comes twice in one batch, and once more with the others."""
    first, second = _halves(spark, sf_dir)
    feed, target = work_folder(spark, "event-feed"), _target(spark, "alerts-once")
    options = _options(spark, state=_state(spark))
    for part in (first.unionByName(first), first.unionByName(second)):
        messages = _flow_feed(spark, feed, part)
        start_uri_scoring(
            messages, scoring_model(spark, sf_dir), target, options, once_within="31 days"
        ).awaitTermination()
    return _written(spark, target).groupBy("srcip", "dstip", "uri").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_distinct("id").alias("ids")
    )


@query(
    "stream_netflow_once",
    f"""
with groups as ({sp.features("fx_netflow", SQL_LABEL)})
select label as attacktype, proto, count(*) as alerts, count(*) as ids,
  cast(sum(flownum) as bigint) as flows
from fx_netflow join (select * exclude (srcports, dstports) from groups) as g
  using (srcip, proto, dstip, recordtime)
where label <> 'normal' group by label, proto
""",
)
def _stream_netflow_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice in one batch: records are counted and alerted once."""
    events = fx.table(spark, sf_dir, "events")
    feed, target = work_folder(spark, "event-feed"), _target(spark, "netflow-once")
    events.unionByName(events).write.parquet(feed)
    source = _on_all_cores(spark.readStream.schema(events.schema).parquet(feed))
    messages = json_messages(netflow_records(fx.netflow_lines(source)))
    options = _options(spark, state=_state(spark))
    start_netflow_scoring(
        messages, netflow_model(spark, sf_dir), target, options, once_within="1 day"
    ).awaitTermination()
    return _written(spark, target).groupBy("attacktype", "proto").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_distinct("recordid").alias("ids"),
        F.sum("flownuma").alias("flows"),
    )


@query(
    "stream_model_versions",
    f"""
with flows as (
  select fx_http.*, epoch_us(ts) < {_MIDDLE} as early from fx_http join events using (event_id)
  where marker <> 'other' and label = 'sql')
select cast(case when early then 1 else 2 end as int) as model_version, srcip, uri, count(*) as alerts
from flows where early or contains(uri, 'UNION') group by early, srcip, uri
""",
)
def _stream_model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the halves of the events a second version comes, which knows one kind of injection alone."""
    versions, feed = work_folder(spark, "model-versions"), work_folder(spark, "event-feed")
    target, options = _target(spark, "version-alerts"), _options(spark)
    models = ModelFeed(lambda: spark.read.parquet(versions))
    paths = (scoring_model_path(spark, sf_dir), union_model_path(spark, sf_dir))
    for version, (half, path) in enumerate(zip(_halves(spark, sf_dir), paths, strict=True), 1):
        row = spark.range(1).select(F.lit(version).alias("version"), F.lit(path).alias("location"))
        row.write.mode("append").parquet(versions)
        start_uri_scoring(_flow_feed(spark, feed, half), models, target, options).awaitTermination()
    return _written(spark, target).groupBy("model_version", "srcip", "uri").agg(
        F.count(F.lit(1)).alias("alerts")
    )
