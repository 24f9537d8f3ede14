"""Inputs of the URI model: training rows, recent flows, flow messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import captured_groups, clean_uri, once

DAY_SECONDS = 86400

# How queries are cut out of URIs and messages are laid out.
QUERY_FROM_FIRST = r"\?(.*)"
FLOW_MESSAGE = r"id\=(.*),uri=.*\?(.*),dstip=(.*),srcip=(.*),date=(.*)"
MESSAGE_URI = r"uri=(.*?),"

#: Column of counted training rows: how many equal rows a row stands for.
COPIES = "copies"


def training_rows(labelled: DataFrame, lexicon: Sequence[str] = ()) -> DataFrame:
    """(label, uri) with the URI as the model wants it."""
    return labelled.select("label", clean_uri(F.col("uri"), lexicon).alias("uri"))


def counted_rows(training: DataFrame) -> DataFrame:
    """Different training rows, with the number of their ``copies``: numbers and codes
    of URIs have become placeholders, so most rows come again and again."""
    return training.groupBy("label", "uri").agg(F.count(F.lit(1)).alias(COPIES))


def query_text(uri: Column, which: str = "first") -> Column:
    """Query of a URI: from the first ``?`` on, or what follows the last one; else ``''``."""
    if which == "first":
        return F.regexp_extract(uri, QUERY_FROM_FIRST, 0)
    if which == "last":
        return F.regexp_extract(uri, r".*\?(.*)", 1)
    raise ValueError(f"which is 'first' or 'last', not {which!r}")


def recent_queries(
    flows: DataFrame, now: int, days: int = 1, lexicon: Sequence[str] = ()
) -> DataFrame:
    """Flows of the last days whose URI has a query, ready to be scored."""
    recent = flows.where(
        (F.col("date") > now - days * DAY_SECONDS)
        & (F.col("date") < now)
        & F.col("uri").contains("?")
    )
    return recent.select(
        clean_uri(query_text(F.col("uri")), lexicon).alias("uri"),
        F.col("uri").alias("uri_ori"),
        "date",
        "srcip",
        "dstip",
        *[name for name in ("id",) if name in flows.columns],
    )


def flow_messages(flows: DataFrame) -> DataFrame:
    """``key`` and ``value`` of the message that announces a flow."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit(absent)))
        for name, absent in (
            ("id", "null"),
            ("uri", "null"),
            ("dstip", "null"),
            ("srcip", "null"),
            ("date", " "),
        )
    ]
    # Whoever parses the messages looks at the text again and again.
    messages = once(flows, "value", F.concat_ws(",", *parts))
    return messages.select(F.lit(None).cast("string").alias("key"), "value")


def parse_flow_messages(
    messages: DataFrame, value: str = "value", lexicon: Sequence[str] = ()
) -> DataFrame:
    """Flows of messages whose URI has a query; ``date`` is null where it is no number.

    The query begins after the last ``?``; ``uri_ori`` ends at the first comma.
    """
    text = F.col(value)
    matching = messages.where(text.contains("?") & text.rlike(FLOW_MESSAGE))
    parsed = once(matching, "_groups", captured_groups(text, FLOW_MESSAGE, [1, 2, 3, 4, 5]))
    groups = F.col("_groups")
    return parsed.select(
        groups[0].alias("id"),
        clean_uri(groups[1], lexicon).alias("uri"),
        F.regexp_extract(text, MESSAGE_URI, 1).alias("uri_ori"),
        groups[4].try_cast("bigint").alias("date"),
        groups[3].alias("srcip"),
        groups[2].alias("dstip"),
    )
