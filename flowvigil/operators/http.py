"""HTTP flow lines to flow rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import json_object, lower_keys, once, origin_of, parse_time, record_id

# The line format and the columns of a flow row.
JSON_SPAN = r"(\{.*\})"
STATIC_RESOURCE = r"\.css|\.js|\.png|\.jpg|\.bmp|\.ico"
SCRIPT_PAGE = ".jsp"
ABSENT = " "
TAG_COLUMNS = ("id", "es_type", "es_index")
FLOW_COLUMNS = (
    "host",
    "mailattach",
    "mailattachpath",
    "mailbcc",
    "mailcc",
    "mailcontent",
    "mailcontentpath",
    "mailfrom",
    "mailsubject",
    "mailto",
    "method",
    "para",
    "password",
    "recvid",
    "row",
    "sendid",
    "sql",
    "srcip",
    "srcmac",
    "srcport",
    "title",
    "type",
    "uri",
    "username",
    "action",
    "appproto",
    "database",
    "date",
    "dbtype",
    "descr",
    "display",
    "dstip",
    "dstmac",
    "dstport",
    "filename",
)


def parse_http(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep lines with a ``{...}`` span; ``flowcontent`` is its object as a map.

    A span that is no JSON object leaves ``flowcontent`` null: see
    :func:`flowvigil.operators.deadletter.network_errors`.
    """
    spans = once(lines, "_span", F.regexp_extract(value, JSON_SPAN, 1))
    return once(spans.where("_span <> ''"), "flowcontent", json_object(F.col("_span"))).drop("_span")


def is_static(uri: Column) -> Column:
    """Style sheets, scripts and pictures, and ``.jsp`` pages."""
    return uri.contains(SCRIPT_PAGE) | uri.rlike(STATIC_RESOURCE)


def drop_static(parsed: DataFrame) -> DataFrame:
    """Drop static resources by the key ``Uri``, in exactly this case."""
    uri = F.coalesce(F.col("flowcontent")["Uri"], F.lit(ABSENT))
    return parsed.where(F.col("flowcontent").isNull() | ~is_static(uri))


def complete(parsed: DataFrame, value: str = "value", id_mode: str = "hash") -> DataFrame:
    """Flow rows: every column of the schema, ``flowcontent`` and ``extra``.

    A key of any case fills the column of its lower-case name, tags included;
    an absent one is a blank. ``extra`` holds the keys the schema does not know.
    ``date`` is an epoch second, null when absent.
    """
    tags = {
        "id": record_id(id_mode, *origin_of(parsed), F.col(value)),
        "es_type": F.lit("flow"),
        "es_index": F.lit("flow"),
    }
    keyed = once(parsed, "_keyed", lower_keys(F.col("flowcontent")))
    given = F.col("_keyed")

    def filled(name: str) -> Column:
        if name == "date":
            return parse_time(given["date"])
        return F.coalesce(given[name], tags.get(name, F.lit(ABSENT)))

    known = TAG_COLUMNS + FLOW_COLUMNS
    return keyed.select(
        *[column for column in parsed.columns if column not in known],
        *[filled(name).alias(name) for name in known],
        F.map_filter(given, lambda key, _: ~key.isin(*known)).alias("extra"),
    )


def http_flows(lines: DataFrame, value: str = "value", id_mode: str = "hash") -> DataFrame:
    """Parse, filter and complete in one go; lines that fail to parse are left out."""
    parsed = drop_static(parse_http(lines, value)).where(F.col("flowcontent").isNotNull())
    return complete(parsed, value, id_mode)
