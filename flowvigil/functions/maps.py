"""JSON objects as maps with case-free keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(text: Column) -> Column:
    """One JSON object as ``map<string,string>``; null where it does not parse."""
    return F.from_json(text, "map<string,string>")


def lower_keys(values: Column) -> Column:
    """Lower-case the keys; of keys that then coincide the last one stays."""
    entries = F.map_entries(values)

    def renamed(keys: Column) -> Column:
        def is_last(entry: Column, position: Column) -> Column:
            later = F.slice(keys, position + 2, F.size(keys))
            return ~F.array_contains(later, F.lower(entry["key"]))

        last_entries = F.transform(
            F.filter(entries, is_last),
            lambda entry: F.struct(F.lower(entry["key"]).alias("key"), entry["value"].alias("value")),
        )
        no_clash = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(no_clash, F.map_from_arrays(keys, F.map_values(values))).otherwise(
            F.map_from_entries(last_entries)
        )

    # A list of one element names the keys, which are lower-cased once and not for each use.
    return F.get(F.transform(F.array(F.transform(F.map_keys(values), F.lower)), renamed), 0)
