"""Features per conversation and record time, and the alerts' port lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_KEYS = ("srcip", "proto", "dstip", "recordtime")

# Fixed value: the order in which models take the features.
FEATURE_COLUMNS = (
    "spandtime",
    "packernum",
    "bytesize",
    "src_flow_port_num",
    "dst_flow_port_num",
    "tcp",
    "udp",
    "flownum",
)
DAY_SECONDS = 86400


def _port_list(ports: str) -> Column:
    return F.concat_ws(",", F.sort_array(F.expr(f"collect_list(DISTINCT {ports})")))


def conversation_sums(duration: Column, packets: Column, size: Column) -> list[Column]:
    """The sums of a conversation, in batches and in windows of a stream."""
    return [
        F.sum(duration).cast("double").alias("spandtime"),
        F.sum(packets).cast("double").alias("packernum"),
        F.sum(size).cast("double").alias("bytesize"),
        F.count(F.lit(1)).cast("double").alias("flownum"),
    ]


def record_sums() -> list[Column]:
    """``conversation_sums`` of netflow records."""
    return conversation_sums(
        F.col("lasttime") - F.col("starttime"),
        F.col("uppkts") + F.col("downpkts"),
        F.col("ups") + F.col("downs"),
    )


def protocol_flags() -> dict[str, Column]:
    """1 where the conversation has the protocol, else 0."""
    return {
        name: F.when(F.col("proto").isin(name, name.upper()), F.lit(1.0)).otherwise(F.lit(0.0))
        for name in ("tcp", "udp")
    }


def _conversations(
    rows: DataFrame,
    sums: Sequence[Column],
    keys: Sequence[str],
    port_lists: bool,
) -> DataFrame:
    """Group by the conversation. Ports count as text, whatever type they have.

    The distinct ports make Catalyst aggregate by (conversation, port) before it
    aggregates by conversation. A conversation that holds a third of all rows is
    thus spread over its ports first, and its last step sees each port once.
    """
    aggregates = [
        *sums,
        F.count_distinct("srcport").cast("double").alias("src_flow_port_num"),
        F.count_distinct("dstport").cast("double").alias("dst_flow_port_num"),
    ]
    if port_lists:
        aggregates += [
            _port_list("srcport").alias("srcports"),
            _port_list("dstport").alias("dstports"),
        ]
    as_text = {name: F.col(name).cast("string") for name in ("srcport", "dstport")}
    return rows.withColumns(as_text).groupBy(*keys).agg(*aggregates).withColumns(protocol_flags())


def _ordered(features: DataFrame, port_lists: bool) -> DataFrame:
    ports = ("srcports", "dstports") if port_lists else ()
    return features.select(
        "srcip", "dstip", "recordtime", "proto", "label", *FEATURE_COLUMNS, *ports
    )


def netflow_features(
    records: DataFrame, label: str = "normal", port_lists: bool = True
) -> DataFrame:
    """Features of netflow records, all of one label."""
    grouped = _conversations(records, record_sums(), GROUP_KEYS, port_lists)
    return _ordered(grouped.withColumn("label", F.lit(label)), port_lists)


def recent_records(records: DataFrame, now: int, days: int) -> DataFrame:
    """Records of the last days, up to whatever is newest."""
    return records.where(F.col("recordtime") > now - days * DAY_SECONDS)


def recent_netflow_features(records: DataFrame, now: int, days: int) -> DataFrame:
    return netflow_features(recent_records(records, now, days))


def attack_features(
    rows: DataFrame, label: str | None = None, port_lists: bool = True
) -> DataFrame:
    """Features of attack captures, which come with duration, packets and bytes.

    Without ``label`` the column of that name is part of the group.
    """
    keys = GROUP_KEYS if label is not None else (*GROUP_KEYS, "label")
    sums = conversation_sums(F.col("costtime"), F.col("packernum"), F.col("bytesize"))
    grouped = _conversations(rows, sums, keys, port_lists)
    if label is not None:
        grouped = grouped.withColumn("label", F.lit(label))
    return _ordered(grouped, port_lists)
