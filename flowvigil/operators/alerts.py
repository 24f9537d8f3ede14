"""Scored rows to alert rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import once, record_id
from flowvigil.operators.features import GROUP_KEYS

# Labels, and the prefix by which the alert tables know these rows.
NORMAL = "normal"
INJECTION = "sql"
ID_PREFIX = "ignore"

INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1

#: Ports per side of one block of a port product.
PORT_BLOCK = 256


def injection_alerts(scored: DataFrame, id_mode: str = "hash") -> DataFrame:
    """Flows that the forest or the regression takes for an injection.

    ``predictionnb`` and ``probabilitynb`` hold the forest's answer: the alert
    table keeps its column names.
    """

    def probability(model: str) -> Column:
        chosen = F.col(f"prediction{model}").cast("int")
        return F.get(vector_to_array(F.col(f"probability{model}")), chosen)

    # Below the model the filter would run the whole of it for each label, and again for the hits.
    hit = (F.col("predictedLabelRF") == INJECTION) | (F.col("predictedLabelLR") == INJECTION)
    hits = once(scored, "_hit", hit).where("_hit")
    if "id" in scored.columns:
        row_id = F.col("id")
    else:
        row_id = record_id(id_mode, F.col("uri_ori"), F.col("date"), F.col("srcip"), F.col("dstip"))
    return hits.select(
        F.concat(F.lit(ID_PREFIX), row_id).alias("id"),
        F.timestamp_seconds("date").alias("date"),
        "srcip",
        "dstip",
        F.col("uri_ori").alias("uri"),
        F.col("predictionRF").alias("predictionnb"),
        probability("RF").alias("probabilitynb"),
        F.col("predictionLR").alias("predictionlr"),
        probability("LR").alias("probabilitylr"),
        F.col("uri_ori").alias("url"),
    )


def attack_groups(scored: DataFrame) -> DataFrame:
    """Conversations that are not normal, with the columns alerts are made of."""
    return scored.where(F.col("predictedLabel") != NORMAL).select(
        "srcip",
        "dstip",
        "predictedLabel",
        "recordtime",
        "spandtime",
        *[name for name in ("srcports", "dstports") if name in scored.columns],
        "proto",
        "packernum",
        "bytesize",
        "flownum",
        "src_flow_port_num",
        "dst_flow_port_num",
    )


def _alert_columns(recordid: Column, cost: Column, srcport: Column, dstport: Column) -> list[Column]:
    def whole(name: str) -> Column:
        # Sums of a busy conversation pass the column's type: they stop at its ends. No sum stays none.
        inside = F.greatest(F.least(F.col(name), F.lit(float(INT_MAX))), F.lit(float(INT_MIN)))
        return F.when(F.col(name).isNotNull(), inside).cast("int")

    return [
        recordid.alias("recordid"),
        F.col("srcip"),
        F.col("dstip"),
        F.col("predictedLabel").alias("attacktype"),
        F.timestamp_seconds(F.col("recordtime").cast("bigint")).alias("recordtime"),
        cost.alias("costtime"),
        srcport.alias("srcport"),
        dstport.alias("dstport"),
        F.col("proto"),
        whole("packernum").alias("packernum"),
        whole("bytesize").alias("bytesize"),
        whole("flownum").alias("flownuma"),
        whole("src_flow_port_num").alias("flownums"),
        whole("dst_flow_port_num").alias("flownumd"),
    ]


def _blocks(ports: Column) -> Column:
    """A comma-separated list as an array of arrays of ``PORT_BLOCK`` ports.

    No ports at all are one block with an empty one, which becomes null.
    """
    listed = F.split(ports, ",")
    starts = F.sequence(F.lit(1), F.size(listed), F.lit(PORT_BLOCK))
    return F.transform(starts, lambda start: F.slice(listed, start, PORT_BLOCK))


def alerts_by_ports(scored: DataFrame) -> DataFrame:
    """One alert per source port and destination port of an attack conversation.

    That is the product of its two port lists, pairs never seen together
    included. It is built in blocks that are spread over the tasks before they
    are expanded, so that one port scan does not expand inside a single task.
    """
    groups = attack_groups(scored)
    blocks = groups.withColumn("_src", F.explode(_blocks(F.col("srcports")))).withColumn(
        "_dst", F.explode(_blocks(F.col("dstports")))
    )
    spread = blocks.drop("srcports", "dstports").repartition(
        *GROUP_KEYS, F.col("_src")[0], F.col("_dst")[0]
    )
    pairs = spread.withColumn("_srcport", F.explode("_src")).withColumn(
        "_dstport", F.explode("_dst")
    )

    def port(name: str) -> Column:
        return F.col(name).try_cast("double").try_cast("int")

    return pairs.select(
        *_alert_columns(F.lit(ID_PREFIX), F.col("spandtime"), port("_srcport"), port("_dstport"))
    )


def alerts_by_record(
    scored: DataFrame,
    records: DataFrame,
    keys: Sequence[str] = GROUP_KEYS,
) -> DataFrame:
    """One alert per record of an attack conversation.

    The conversations are joined back to their records on the group keys instead
    of carrying all their records in one cell. Both sides get a shuffle of their
    own below the join, so adaptive execution splits a conversation however large
    it is. Records are not merged: equal lines give as many alerts as there are
    records, and ids tell them apart if the lines carry their origin. ``costtime``
    is in milliseconds here.
    """
    # Dealt by a hash of the keys, not by the keys: the aggregate's own layout
    # would spare the join a shuffle on this side, and with it the split.
    groups = attack_groups(scored).drop("srcports", "dstports").repartition(F.xxhash64(*keys))
    wanted = records.select(*keys, "recordid", "srcport", "dstport")
    return wanted.join(groups, list(keys)).select(
        *_alert_columns(
            F.concat(F.lit(ID_PREFIX), F.col("recordid")),
            F.col("spandtime") * 1000,
            F.col("srcport").try_cast("double").try_cast("int"),
            F.col("dstport").try_cast("double").try_cast("int"),
        )
    )
