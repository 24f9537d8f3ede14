"""Log lines and tables derived from the driver tables, row by row.

Spark gets raw text and has to parse it; the SQL checks compute the same answer
straight from the columns. ``sql_*`` constants are shared by both dialects, with
``{EPOCH}`` for the epoch second of an event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.functions import once
from flowvigil.sources.tables import spread

SPARK_EPOCH = "unix_seconds(cast(ts as timestamp))"
DUCKDB_EPOCH = "cast(floor(epoch(ts)) as bigint)"

SQL_NETFLOW = """
select event_id,
  concat('10.0.0.', cast(user_id % 8 as string)) as srcip,
  concat('10.0.1.', cast(event_id % 4 as string)) as dstip,
  1024 + (event_id * 7) % 13 as srcport,
  20 + event_id % 5 as dstport,
  case event_id % 3 when 0 then 'tcp' when 1 then 'UDP' else 'icmp' end as proto,
  {EPOCH} as starttime,
  {EPOCH} + event_id % 60 as lasttime,
  {EPOCH} - ({EPOCH} % 604800) as recordtime,
  case when event_id % 17 = 0 then null else event_id % 11 end as uppkts,
  event_id % 13 as downpkts,
  (event_id * 17) % 1500 as ups,
  (event_id * 31) % 1500 as downs
from events
"""

SQL_HTTP = """
select event_id, {EPOCH} as epoch_s,
  concat('10.0.0.', cast(user_id % 8 as string)) as srcip,
  concat('10.0.1.', cast(event_id % 4 as string)) as dstip,
  case event_id % 3 when 0 then 'netlog_http' when 1 then 'netlog_bd' else 'other' end as marker,
  case event_id % 8
    when 0 then '/static/a.css'
    when 1 then '/x/app.js?v=1'
    when 2 then '/list?id=1%27%20or%201=1--'
    when 3 then '/s?q=100%&b=a1b2c3'
    when 4 then '/login'
    when 5 then concat('/item?id=', cast(event_id as string), '&name=Foo+Bar')
    when 6 then '/q?u=1%20UNION%20SELECT%20pwd'
    else '/a?x=1?y=2,3' end as uri,
  case when event_id % 8 in (2, 6) then 'sql' else 'normal' end as label
from events
"""

SQL_SYSLOG = """
select event_id,
  concat('172.16.0.', cast(user_id % 5 as string)) as reportip,
  case event_id % 6
    when 0 then concat('edge7 waf: stat_time:2024-01-', lpad(cast(1 + event_id % 28 as string), 2, '0'), ' 10:',
      lpad(cast(event_id % 60 as string), 2, '0'), ':09 event_type:', case event_id % 5 when 0 then 'xss' when 1 then 'sqli' else 'lfi' end,
      ' dst_ip:192.0.2.', cast(event_id % 200 as string), ' dst_port:', cast(8000 + event_id % 90 as string), ' url:/p', cast(event_id as string),
      ' src_ip:198.51.100.', cast(user_id % 250 as string), ' src_port:', cast(1025 + event_id % 60000 as string), ' method:POST')
    when 1 then concat('Attack:flood', cast(event_id % 9 as string), ' src=198.51.100.', cast(user_id % 250 as string), ' dst=192.0.2.',
      cast(event_id % 200 as string), ' sport=', cast(1025 + event_id % 60000 as string), ' dport=', cast(event_id % 1000 as string), ' flag')
    when 2 then concat('x logtype=1;datetime=', lpad(cast(1 + event_id % 28 as string), 2, '0'), '/Jan/2024:08:15:', lpad(cast(event_id % 60 as string), 2, '0'),
      ';eventID=', cast(event_id as string), ';dstip=192.0.2.', cast(event_id % 200 as string), ';eventType=kind', cast(event_id % 7 as string), ';severity=2;description=big')
    when 3 then concat('ids {"id":1,"time":', cast(1700000000000 + event_id * 1000 as string), ',"source":{"ip":"198.51.100.', cast(user_id % 250 as string),
      '","port":', cast(1025 + event_id % 60000 as string), ',"a":1},"z":0,"destination":{"ip":"192.0.2.', cast(event_id % 200 as string),
      '","port":', cast(event_id % 1000 as string), ',"b":2},"protocol":"tcp","subject":"scan', cast(event_id % 7 as string), '","message":"m"}')
    when 4 then concat(cast(event_id as string), ' x attack_name(4)=sqli', cast(event_id % 9 as string), ';app_protocol_name(3)=(2)http;protocol(1)=6;src_ip(3)=198.51.100.',
      cast(user_id % 250 as string), ';src_port(1)=', cast(1025 + event_id % 60000 as string), ';dst_ip(1)=192.0.2.', cast(event_id % 200 as string),
      ';dst_port(1)=', cast(event_id % 1000 as string), ';block_reason=0')
    else 'heartbeat message' end as body,
  case when event_id % 12 = 11 then '|!ok' else '' end as tail
from events
"""  # noqa: E501

SQL_SYSLOG_LINE = """
select event_id, reportip, body,
  concat(cast(event_id as string), repeat('|!x', 28), '|!', reportip, '|!pad|!', body, tail) as value
from fx_syslog
"""  # noqa: E501

SQL_ATTACK = """
select concat('10.9.', cast(l_suppkey % 16 as string), '.', cast(l_partkey % 8 as string)) as srcip,
  concat('10.1.0.', cast(l_linenumber as string)) as dstip,
  cast(year(l_shipdate) as bigint) as recordtime,
  case l_returnflag when 'A' then 'tcp' when 'N' then 'udp' else 'icmp' end as proto,
  l_quantity as costtime, cast(floor(l_extendedprice) as bigint) as bytesize,
  l_partkey % 100 as packernum,
  1024 + l_orderkey % 500 as srcport, 1 + l_suppkey % 50 as dstport,
  case when l_linenumber = 7 then 'PORTSCAN' when l_linenumber >= 5 then 'DOS' else 'FLOOD' end
    as label
from lineitem
"""

# (ruleid, sourceip, destip, pattern): a plain hit; an address that can only equal
# itself; an address that is a wildcard for want of an escaped dot; low priority.
RULES = (
    ("R1", "any", "any", r"union\s+select"),
    ("R2", r"10\.0\.0\.3", "any", "or 1=1"),
    ("R3", "10.0.0.9", "any", r"or\s+1=1"),
    ("R4", "any", "any", "id="),
)

# Second fixed by all scheduled jobs in the checks: events span January 2024.
NOW = 1_706_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the events that lines are made of, on as many cores as there are."""
    columns = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return spread(columns, spark.sparkContext.defaultParallelism)


def _derive(source: DataFrame, sql: str, name: str) -> DataFrame:
    """Run a shared select over a table without registering it in the session."""
    select = sql.replace("{EPOCH}", SPARK_EPOCH).replace("{", "{{").replace("}", "}}")
    return source.sparkSession.sql(select.replace(f"from {name}", "from {source}"), source=source)


def netflow_columns(source: DataFrame) -> DataFrame:
    return _derive(source, SQL_NETFLOW, "events")


def http_columns(source: DataFrame) -> DataFrame:
    return _derive(source, SQL_HTTP, "events")


def attack_columns(source: DataFrame) -> DataFrame:
    return _derive(source, SQL_ATTACK, "lineitem")


def as_lines(df: DataFrame, line: Column) -> DataFrame:
    """Lines as a stored column would be: whatever reads them does not make them anew."""
    return once(df, "value", line).select("value")


def _record() -> Column:
    """A record with keys of mixed case; absent packet counts leave no key."""
    names = {
        "srcip": "SrcIp",
        "dstip": "DstIp",
        "srcport": "SrcPort",
        "dstport": "dstPort",
        "proto": "Proto",
        "starttime": "starttime",
        "lasttime": "LastTime",
        "recordtime": "recordtime",
        "uppkts": "UpPkts",
        "downpkts": "DownPkts",
        "ups": "ups",
        "downs": "downs",
    }
    fields = [F.col(name).alias(key) for name, key in names.items()]
    return F.struct(*fields, F.lit("http").alias("Proto7"), F.col("event_id").alias("Seq"))


def netflow_lines(source: DataFrame) -> DataFrame:
    """One line per event, with one record."""
    body = F.to_json(F.array(_record()))
    return netflow_columns(source).transform(as_lines, _netflow_line(body))


def grouped_netflow_lines(source: DataFrame) -> DataFrame:
    """Lines of up to three records."""
    grouped = (
        netflow_columns(source)
        .groupBy(F.floor(F.col("event_id") / 3).alias("message"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", _record().alias("r")))).alias("rs"))
    )
    return grouped.transform(as_lines, _netflow_line(F.to_json(F.col("rs.r"))))


def _netflow_line(body: Column) -> Column:
    return F.concat(F.lit("sensor send a message: ["), body, F.lit("]"))


def http_lines(source: DataFrame) -> DataFrame:
    payload = F.to_json(
        F.struct(
            F.col("uri").alias("Uri"),
            F.col("srcip").alias("SrcIp"),
            F.col("dstip").alias("DstIp"),
            F.lit("GET").alias("Method"),
            F.from_unixtime("epoch_s").alias("Date"),
            F.col("event_id").alias("Seq"),
        )
    )
    line = F.concat(F.lit("<13> "), F.col("marker"), F.lit(" "), payload)
    return as_lines(http_columns(source), line)


def syslog_lines(source: DataFrame) -> DataFrame:
    bodies = _derive(source, SQL_SYSLOG, "events")
    return as_lines(_derive(bodies, SQL_SYSLOG_LINE, "fx_syslog"), F.col("value"))


def noise_lines(source: DataFrame) -> DataFrame:
    """A marker with nothing behind it per event: neither HTTP nor netflow."""
    return source.select(F.concat(F.lit("idle "), "event_id", F.lit(" netlog_http")).alias("value"))


def broken_lines(source: DataFrame) -> DataFrame:
    """One HTTP line per event with a cut payload."""
    return source.select(
        F.concat(F.lit('netlog_http {"Uri":"/a?b=1","Seq":'), "event_id", F.lit(',,}')).alias("value")
    )


def rules(spark: SparkSession) -> DataFrame:
    values = [(position, *rule) for position, rule in enumerate(RULES)]
    return spark.createDataFrame(
        values,
        "rule_pos int, ruleid string, sourceip string, destip string, "
        "rule_regular_expression string",
    )


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labelled by a word that only some of them have."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    label = F.when(F.coalesce(F.col("text"), F.lit("")).contains(" the "), "good").otherwise("bad")
    return documents.select(label.alias("label"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")
