"""Netflow lines to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import lower_keys, once, origin_of, record_id

# The line format and the keys of a record.
RECORD_SPAN = r"send a message:.\[(\[.*\])\]"
TEXT_FIELDS = ("srcip", "dstip", "srcport", "dstport", "proto", "proto7")
NUMBER_FIELDS = (
    "starttime",
    "lasttime",
    "recordtime",
    "ups",
    "downs",
    "uppkts",
    "downpkts",
)


def netflow_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that carry records, as ``records: array<map<string,string>>``.

    A span that is no JSON array leaves ``records`` null, for the dead letters.
    """
    spans = once(lines, "_span", F.regexp_extract(value, RECORD_SPAN, 1))
    found = spans.where("_span <> ''")
    return once(found, "records", F.from_json("_span", "array<map<string,string>>")).drop("_span")


def explode_records(
    messages: DataFrame, value: str = "value", id_mode: str = "hash"
) -> DataFrame:
    """One row per record: ``record`` with lower-case keys, ids and tags.

    ``packernum`` is there only if both packet counts are whole numbers.
    """
    kept = [column for column in messages.columns if column != "records"]
    rows = messages.select(*kept, F.posexplode("records").alias("record_pos", "_raw"))
    keyed = once(rows, "record", lower_keys(F.col("_raw"))).drop("_raw")
    record = F.col("record")
    packets = record["downpkts"].try_cast("bigint") + record["uppkts"].try_cast("bigint")
    return (
        keyed.withColumn("recordid", record_id(id_mode, *origin_of(keyed), F.col(value), F.col("record_pos")))
        .withColumn("es_type", F.lit("netflow"))
        .withColumn("es_index", F.lit("netflow"))
        .withColumn("packernum", packets)
    )


def typed_records(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Known keys of a record as typed columns; what is no number is null.

    ``extra`` holds every other key, and the text of numbers that are none, so
    that a document of the row loses nothing.
    """
    record = F.col("record")
    known = (*TEXT_FIELDS, *NUMBER_FIELDS, "recordid", "es_type", "es_index", "packernum")
    extra = F.map_filter(
        record,
        lambda key, text: ~key.isin(*known)
        | (key.isin(*NUMBER_FIELDS) & text.isNotNull() & text.try_cast("bigint").isNull()),
    )
    return rows.select(
        *keep,
        "recordid",
        "es_type",
        "es_index",
        *[record[name].alias(name) for name in TEXT_FIELDS],
        *[record[name].try_cast("bigint").alias(name) for name in NUMBER_FIELDS],
        "packernum",
        extra.alias("extra"),
    )


def netflow_records(lines: DataFrame, value: str = "value", id_mode: str = "hash") -> DataFrame:
    """Typed records of netflow lines; lines without records vanish."""
    return typed_records(explode_records(netflow_messages(lines, value), value, id_mode))
