"""The table of vendor syslog patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.operators.syslog import SyslogPattern

XML_SCHEMA = (
    "_id string, _position int, _requires string, _optional string, content string, "
    "field array<struct<_id: string, _group: int>>"
)

# Expressions and groups of the vendor formats, by priority.
VENDOR_PATTERNS = (
    SyslogPattern(
        "ips",
        r"(\d+)\s+.*attack_name\(\d+\)=(.*);app_protocol_name.*=\(\d+\)(.*);protocol.*src_ip\(\d+\)=(.*);src_port\(\d+\)=(.*);dst_ip\(\d+\)=(.*);dst_port\(\d+\)=(.*);block_reason.*",  # noqa: E501
        (
            ("eventname", 2),
            ("sourceip", 4),
            ("sourceport", 5),
            ("destip", 6),
            ("destport", 7),
        ),
        ("attack_name(", ";app_protocol_name", ";block_reason"),
    ),
    SyslogPattern(
        "ids",
        r'.+\{.*"time":(.*),"source":\{"\w+":"(.*)","port":(\d+),.*,"destination":\{"\w+":"(.*)","port":(\d+),.*\},.*"protocol":"(.*)","subject":"(.*)","message":.*',  # noqa: E501
        (
            ("firstrecvtime", 1),
            ("sourceip", 2),
            ("sourceport", 3),
            ("destip", 4),
            ("destport", 5),
            ("eventname", 7),
        ),
        ('"time":', ',"source":{', ',"destination":{', '","subject":"', '","message":'),
    ),
    SyslogPattern(
        "nta",
        r".*logtype=.*;datetime=(.*);eventID=.*dstip=(.*);eventType=(.*);severity=.*description=(.*)",  # noqa: E501
        (("firstrecvtime", 1), ("destip", 2), ("eventname", 3)),
        ("logtype=", ";datetime=", ";eventID=", ";eventType=", ";severity="),
    ),
    SyslogPattern(
        "ads",
        r".*Attack:(.*)\s+src=(.*)\s+dst=(.*)\s+sport=(.*)\s+dport=(\d+).*",
        (("sourceip", 2), ("sourceport", 4), ("destip", 3), ("eventname", 1)),
        ("Attack:", "src=", "dst=", "sport=", "dport="),
    ),
    SyslogPattern(
        "waf",
        r".*waf.*stat_time:(.*)event_type:(.*)dst_ip:(.*)dst_port:(\d+)\s*(url:.*){0,1}src_ip:(.*)src_port:(\d+).*method.*",  # noqa: E501
        (
            ("firstrecvtime", 1),
            ("eventname", 2),
            ("destip", 3),
            ("destport", 4),
            ("sourceip", 6),
            ("sourceport", 7),
        ),
        ("waf", "stat_time:", "event_type:", "dst_port:", "src_port:", "method"),
    ),
)


def pattern_table(spark: SparkSession, patterns: Sequence[SyslogPattern]) -> DataFrame:
    """Patterns as rows in the layout of the XML file."""
    values = [
        (p.id, k, "\n".join(p.requires) or None, "\n".join(p.optional) or None, p.pattern, p.fields)
        for k, p in enumerate(patterns)
    ]
    return spark.createDataFrame(values, XML_SCHEMA).coalesce(1)


def write_patterns(table: DataFrame, path: str) -> None:
    table.write.format("xml").option("rootTag", "patterns").option("rowTag", "pattern").save(path)


def read_patterns(spark: SparkSession, path: str) -> tuple[SyslogPattern, ...]:
    """Patterns of XML files by their attribute ``position``; those without one come
    last, in file order, which is sure for a single file that one task reads.

    ``<pattern id=..><content>..</content><field id=.. group=../>..</pattern>``;
    the attributes ``requires`` and ``optional`` hold one entry per line. The
    table is configuration that people write, and turns into expressions.
    """
    table = (
        spark.read.format("xml")
        .option("rowTag", "pattern")
        .schema(XML_SCHEMA)
        .load(path)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return tuple(
        SyslogPattern(
            row["_id"],
            row["content"],
            tuple((field["_id"], field["_group"]) for field in row["field"] or ()),
            tuple((row["_requires"] or "").split("\n")) if row["_requires"] else (),
            tuple((row["_optional"] or "").split("\n")) if row["_optional"] else (),
        )
        for row in table.orderBy(F.col("_position").asc_nulls_last(), "_pos").collect()
    )
