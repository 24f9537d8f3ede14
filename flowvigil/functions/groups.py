"""Several groups of one match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR = "\x1f"


def captured_groups(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """The groups of the first match as an array; empty texts where there is none.

    ``regexp_extract`` searches once per group. Here one search replaces the
    whole text by the groups, joined by a control character. Text that holds this
    character, or no match, is told by the number of parts and extracted group by
    group instead.
    """
    one_by_one = F.array(*[F.regexp_extract(text, pattern, group) for group in groups])
    if len(groups) < 2:
        return one_by_one
    whole = f"^(?s:.*?)(?:{pattern})(?s:.*)$"
    joined = F.regexp_replace(text, whole, _SEPARATOR.join(f"${group}" for group in groups))

    def told(parts: Column) -> Column:
        return F.when(F.size(parts) == len(groups), parts).otherwise(one_by_one)

    # A list of one element names the parts: the search runs once and not for each use.
    return F.get(F.transform(F.array(F.split(joined, _SEPARATOR, -1)), told), 0)
