"""Conversation features over event-time windows and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.operators.features import FEATURE_COLUMNS, protocol_flags, record_sums


def _features_by(records: DataFrame, event_time: str, window: Column, delay: str) -> DataFrame:
    """Streams have no distinct counts, so the state holds the set of ports, which
    the number of ports bounds."""
    return (
        records.withWatermark(event_time, delay)
        .groupBy(window.alias("window"), "srcip", "dstip", "proto")
        .agg(
            *record_sums(),
            F.size(F.collect_set("srcport")).cast("double").alias("src_flow_port_num"),
            F.size(F.collect_set("dstport")).cast("double").alias("dst_flow_port_num"),
        )
        .withColumns(protocol_flags())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "srcip",
            "dstip",
            "proto",
            *FEATURE_COLUMNS,
        )
    )


def windowed_features(
    records: DataFrame, event_time: str, width: str, delay: str
) -> DataFrame:
    """Features per window and conversation, emitted once the watermark passes."""
    return _features_by(records, event_time, F.window(event_time, width), delay)


def session_features(records: DataFrame, event_time: str, gap: str, delay: str) -> DataFrame:
    """Features per conversation and session: records at most ``gap`` apart.

    A session stays in the state over batches and restarts until the watermark
    passes its end, ``gap`` behind its last record; a record between two open
    sessions makes them one. Records without a time belong to none. No record
    later than ``delay`` changes a session.
    """
    timed = records.where(F.col(event_time).isNotNull())
    return _features_by(timed, event_time, F.session_window(event_time, gap), delay)
