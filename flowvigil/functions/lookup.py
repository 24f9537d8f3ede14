"""Constant tables that an expression looks up in constant time.

A map literal is searched entry by entry. Here the entries are dealt to buckets by
a hash of their key, and an array literal of buckets is read by position, so the
cost of a lookup does not grow with the table. The table is a constant of the
plan: it belongs to what a job is configured with, not to data.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries that a bucket holds on average at most.
PER_BUCKET = 2


class HashedTable:
    """Rows (``fields``, the first is the key, a string) to be looked up by key."""

    def __init__(self, fields: str, rows: Sequence[Mapping[str, Any]], key: str) -> None:
        self._key = key
        self._size = max(1, len(rows) // PER_BUCKET)
        buckets: list[list[Mapping[str, Any]]] = [[] for _ in range(self._size)]
        for row in rows:
            buckets[zlib.crc32(row[key].encode()) % self._size].append(row)
        text = json.dumps(buckets, ensure_ascii=False)
        # Folded to one literal before the query runs.
        self._buckets = F.from_json(F.lit(text), f"array<array<struct<{fields}>>>")

    def rows_of(self, key: Column) -> Column:
        """All rows with this key, as an array of structs."""
        place = (F.crc32(key) % self._size).cast("int") + F.lit(1)
        return F.filter(F.element_at(self._buckets, place), lambda row: row[self._key] == key)
