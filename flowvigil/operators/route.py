"""Tell HTTP log lines from netflow lines."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the collectors write into HTTP lines.
HTTP_MARKERS = ("netlog_http", "netlog_bd")


def is_http(value: Column, markers: Sequence[str] = HTTP_MARKERS) -> Column:
    """A marker occurs, and something other than markers comes after it.

    The plain substring tests come first: most netflow lines end there without
    running the regular expression.
    """
    any_marker = "|".join(re.escape(marker) for marker in markers)
    mentioned = reduce(lambda left, right: left | right, [value.contains(m) for m in markers])
    return mentioned & value.rlike(rf"(?:{any_marker})(?!(?:{any_marker})*\z)")


def route(
    lines: DataFrame, value: str = "value", markers: Sequence[str] = HTTP_MARKERS
) -> DataFrame:
    """Add ``route``: ``http`` or ``netflow``."""
    http = is_http(F.col(value), markers)
    return lines.withColumn("route", F.when(http, "http").otherwise("netflow"))
