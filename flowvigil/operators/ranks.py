"""Ranks and running totals over all rows, without a task that sees all rows.

The rows are dealt by ranges of their order, each range is summed, and what the
ranges before a row hold is added to its place inside its own range. The driver
sees one row for each range, and there are as many ranges as partitions of a
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvigil.session import work_folder

_RANGE = "_range"


def _in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows with the number of their range, stored: a rerun may cut other ranges."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = work_folder(spark, "ranges")
    dealt = df.repartitionByRange(parts, *order).withColumn(_RANGE, F.spark_partition_id())
    dealt.write.parquet(folder)
    return spark.read.schema(dealt.schema).parquet(folder)


def running_totals(df: DataFrame, order: Sequence[Column], totals: Mapping[str, Column]) -> DataFrame:
    """Add for each name the total of its column over this row and all before it.

    ``order`` has to tell all rows apart that should not get the same neighbours
    in any order; rows equal in it stay in one range. Totals are whole numbers.
    """
    values = {f"_value_{k}": value.cast("bigint") for k, value in enumerate(totals.values())}
    ranged = _in_ranges(df.withColumns(values), order)
    summed = ranged.groupBy(_RANGE).agg(*[F.sum(name).alias(name) for name in values]).orderBy(_RANGE).collect()
    before = {name: 0 for name in values}
    carried = []
    for row in summed:
        carried.append((row[_RANGE], *before.values()))
        before = {name: total + (row[name] or 0) for name, total in before.items()}
    fields = ", ".join(f"_before_{name} bigint" for name in values)
    offsets = df.sparkSession.createDataFrame(carried, f"_of int, {fields}")
    inside = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = ranged.withColumns({name: F.coalesce(F.sum(name).over(inside), F.lit(0)) for name in values})
    joined = within.join(F.broadcast(offsets), F.col(_RANGE) == F.col("_of"))
    found = [
        (F.col(value) + F.col(f"_before_{value}")).alias(name) for name, value in zip(totals, values, strict=True)
    ]
    return joined.select(*[F.col(f"`{name}`") for name in df.columns if name not in totals], *found)


def global_ranks(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the place of each row in this order, from 1; no two rows get the same."""
    return running_totals(df, order, {name: F.lit(1)})
