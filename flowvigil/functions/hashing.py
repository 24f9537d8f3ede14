"""Stable ids and the 31-based string hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MASK = 0xFFFFFFFF
_SIGN = 0x80000000


def java_hash(text: Column) -> Column:
    """``h = 31 * h + unit`` over UTF-16 units in signed 32 bits, as a bigint."""

    def fold(total: Column, unit: Column) -> Column:
        return (total * 31 + unit).bitwiseAND(F.lit(_MASK))

    def step(total: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        above = point - 0x10000
        high = F.shiftright(above, 10) + 0xD800
        low = above.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(point < 0x10000, fold(total, point)).otherwise(fold(fold(total, high), low))

    unsigned = F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), step)
    return unsigned.bitwiseXOR(F.lit(_SIGN)) - F.lit(_SIGN)


#: Column that names the place a line comes from: a topic, partition and offset,
#: a file and position, or whatever the caller knows it by.
ORIGIN = "origin"


def origin_of(df: DataFrame) -> tuple[Column, ...]:
    """The line's place, if the frame carries it, as a part of ids."""
    return (F.col(ORIGIN),) if ORIGIN in df.columns else ()


def record_id(id_mode: str, *parts: Column) -> Column:
    """Id of a derived row.

    ``hash`` depends on the parts alone, so that a retried task and every sink
    see the same id. Equal lines differ only by their origin (see ``origin_of``).
    Absent parts count, so rows differ that have a value in another place.
    ``uuid`` is random: write or persist such rows before they go to more than
    one sink.
    """
    if id_mode == "hash":
        return F.md5(F.concat_ws("|", *[F.coalesce(part.cast("string"), F.lit("\x00")) for part in parts]))
    if id_mode == "uuid":
        return F.expr("uuid()")
    raise ValueError(f"id_mode is 'hash' or 'uuid', not {id_mode!r}")
