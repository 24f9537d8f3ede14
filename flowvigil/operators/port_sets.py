"""Sets of ports as bitmaps that merge: bounded cells in place of distinct lists.

A set of ports is at most two bitmaps of 4 KB, however many records it stands for.
Cells of one conversation are merged by OR, so the same cell serves a batch, a
day and the week that is rolled up from days, and counts are exact at each step.
Texts that are no port number (0 to 65535, written without leading zeros) stand
beside the bitmaps, one row for each different text, so nothing is lost for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_PORT = 65535
#: Columns of a cell beside its keys: which half of the ports, a text that is no port, the bits.
CELL = ("half", "odd", "bits")
_BITS = 32768
_BYTES = _BITS // 8


def _number(port: Column) -> Column:
    """1 to 65536 for a port number, else null; the bitmaps count from 1."""
    plain = port.cast("string")
    number = F.when(F.regexp_like(plain, F.lit("^(0|[1-9][0-9]{0,4})$")), plain.cast("int"))
    return F.when(number <= MOST_PORT, number + F.lit(1))


def port_cells(rows: DataFrame, keys: Sequence[str], port: str) -> DataFrame:
    """``keys, half, odd, bits``: the ports of each conversation. Null ports are none.

    The bitmaps are built in each task before anything is shuffled, so a
    conversation that holds most rows sends two cells from each task.
    """
    numbered = rows.where(F.col(port).isNotNull()).withColumn("_number", _number(F.col(port)))
    return (
        numbered.select(
            *keys,
            F.bitmap_bucket_number("_number").alias("half"),
            F.when(F.col("_number").isNull(), F.col(port).cast("string")).alias("odd"),
            F.bitmap_bit_position(F.coalesce("_number", F.lit(1))).alias("_bit"),
        )
        .groupBy(*keys, "half", "odd")
        .agg(F.bitmap_construct_agg("_bit").alias("bits"))
    )


def merge_cells(cells: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Cells of coarser (or the same) keys."""
    return cells.groupBy(*keys, "half", "odd").agg(F.bitmap_or_agg("bits").alias("bits"))


def cell_ports() -> Column:
    """How many ports a merged cell stands for."""
    return F.when(F.col("odd").isNull(), F.bitmap_count("bits")).otherwise(F.lit(1).cast("bigint"))


def count_of_ports() -> Column:
    """An aggregate over merged cells: the exact number of different ports."""
    return F.sum(cell_ports()).cast("double")


def port_counts(cells: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and the exact number of different ports, of cells that are merged by ``keys``."""
    return cells.groupBy(*keys).agg(count_of_ports().alias(name))


def _listed() -> Column:
    """The ports of a merged cell as an array of texts."""
    first = (F.col("half") - 1) * _BITS

    def of_byte(one: Column) -> Column:
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda bit: F.getbit(one["byte"], bit) == 1)
        return F.transform(set_bits, lambda bit: (first + one["place"] * 8 + bit).cast("string"))

    byte = lambda k: F.substring(F.col("bits"), k + F.lit(1), F.lit(1))
    used = F.filter(F.sequence(F.lit(0), F.lit(_BYTES - 1)), lambda k: byte(k) != F.lit(b"\0"))
    placed = F.transform(
        used, lambda k: F.struct(k.alias("place"), F.conv(F.hex(byte(k)), 16, 10).cast("int").alias("byte"))
    )
    ports = F.flatten(F.transform(placed, of_byte))
    return F.when(F.col("odd").isNull(), ports).otherwise(F.array("odd"))


def list_of_ports() -> Column:
    """An aggregate over merged cells: the ports in the order of their texts, comma-joined."""
    return F.concat_ws(",", F.sort_array(F.flatten(F.collect_list(_listed()))))


def port_lists(cells: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and the list of their ports, of cells that are merged by ``keys``."""
    return cells.groupBy(*keys).agg(list_of_ports().alias(name))
