"""Netflow records as messages, in JSON and in the ``k -> v`` text."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.functions import captured_groups, once

# Names of keys, the text between key and value, and keys all of which a line must have.
ARROW = " -> "
TEXT_KEYS = (
    "downpkts",
    "packernum",
    "srcip",
    "lasttime",
    "proto",
    "es_type",
    "recordtime",
    "recordid",
    "starttime",
    "srcport",
    "dstip",
    "ups",
    "proto7",
    "uppkts",
    "dstport",
    "downs",
)
NUMBER_KEYS = (
    "downpkts",
    "packernum",
    "lasttime",
    "recordtime",
    "starttime",
    "ups",
    "uppkts",
    "downs",
)
RECORD_COLUMNS = tuple(name for name in TEXT_KEYS if name not in ("es_type", "proto7"))
JSON_SCHEMA = ", ".join(
    f"{name} {'double' if name in NUMBER_KEYS else 'string'}" for name in TEXT_KEYS
)


def json_messages(records: DataFrame) -> DataFrame:
    """``key`` and ``value``: the record as JSON; absent values leave no key."""
    present = [name for name in TEXT_KEYS if name in records.columns]
    return records.select(
        F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*present)).alias("value")
    )


def _json_record(value: str) -> Column:
    """The record, with ``_bad`` set where the text is no object or a number is none."""
    return F.from_json(
        F.col(value), f"{JSON_SCHEMA}, _bad string", {"columnNameOfCorruptRecord": "_bad"}
    )


def json_message_errors(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``error``, null for messages that ``parse_json_messages`` takes."""
    record = F.col("_record")
    bad = record.isNull() | record["_bad"].isNotNull()
    error = F.when(bad, "netflow message is no JSON object with numbers where they belong")
    return once(once(messages, "_record", _json_record(value)), "error", error).drop("_record")


def parse_json_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Records of JSON messages; what does not parse is left to ``json_message_errors``."""
    parsed = once(messages, "_record", _json_record(value))
    good = parsed.where(F.col("_record").isNotNull() & F.col("_record")["_bad"].isNull())
    return good.select(*[F.col("_record")[name].alias(name) for name in RECORD_COLUMNS])


def text_messages(records: DataFrame) -> DataFrame:
    """``Map(k -> v, …)`` text of records; absent values leave no entry."""
    entries = [
        F.concat(F.lit(name + ARROW), F.col(name).cast("string"))
        for name in TEXT_KEYS
        if name in records.columns
    ]
    body = F.concat(F.lit("Map("), F.concat_ws(", ", *entries), F.lit(")"))
    return records.select(F.lit(None).cast("string").alias("key"), body.alias("value"))


def _all_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left & right, tests)


def _entries(text: Column) -> Column:
    """``(k -> v, k -> v)`` as a map; of entries with the same key the first stays."""
    entries = F.split(F.regexp_extract(text, r"\((.*)\)", 1), ", ")
    keys = F.transform(entries, lambda entry: F.substring_index(entry, ARROW, 1))
    values = F.transform(
        entries,
        lambda entry: F.substring(entry, F.instr(entry, ARROW) + len(ARROW), F.length(entry)),
    )
    firsts = F.filter(
        F.arrays_zip(keys.alias("key"), values.alias("value")),
        lambda entry, position: F.array_position(keys, entry["key"]) == position + 1,
    )
    no_clash = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(no_clash, F.map_from_arrays(keys, values)).otherwise(F.map_from_entries(firsts))


def parse_text_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Records of ``k -> v`` texts, in whatever order the keys come; the usual one
    takes a single search.

    A text that lacks a key is dropped. A number that does not parse is null.
    """
    text = F.col(value)
    likely = messages.where(_all_of(text.contains(name + ARROW) for name in TEXT_KEYS))
    in_order = ", ".join(f"{name}{ARROW}(.*?)" for name in TEXT_KEYS) + r"\)"
    entries = _entries(text)
    values = F.when(
        text.rlike(in_order), captured_groups(text, in_order, range(1, len(TEXT_KEYS) + 1))
    ).otherwise(F.transform(F.array(*map(F.lit, TEXT_KEYS)), lambda name: entries[name]))
    parsed = once(likely, "_values", values)
    fields = {name: F.col("_values")[position] for position, name in enumerate(TEXT_KEYS)}
    columns = [
        (fields[name].try_cast("double") if name in NUMBER_KEYS else fields[name]).alias(name)
        for name in RECORD_COLUMNS
    ]
    complete = ~F.exists("_values", lambda field: field.isNull())
    return parsed.where(complete).select(*columns, text.alias("netflow"))
