"""Conversation features from stored partials instead of records.

Each batch of records leaves two small tables of partials: sums for each
conversation, and cells of its ports. Both merge, so a job over the last days reads
partials alone, and records that come late, for days long past, are partials of
the batch they come in: whoever reads next has them counted where they belong. A
batch that is run again overwrites its own partials and counts once.

Tables are stored by day of the record time and by batch. A job names the days
it needs and reads their folders alone; batches of a day are merged when read, or
for good by :func:`compact`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowvigil.operators.features import DAY_SECONDS, FEATURE_COLUMNS, GROUP_KEYS, protocol_flags, record_sums
from flowvigil.operators.port_sets import CELL, count_of_ports, list_of_ports, merge_cells, port_cells

_SUMS = ("spandtime", "packernum", "bytesize", "flownum")
#: What ``record_sums`` adds up.
_SUMMED = ("starttime", "lasttime", "uppkts", "downpkts", "ups", "downs")
_PORTS = {"srcport": ("src_flow_port_num", "srcports"), "dstport": ("dst_flow_port_num", "dstports")}
_DAY = "day"
_BATCH = "batch"


def _day() -> Column:
    return F.floor(F.col("recordtime") / DAY_SECONDS).cast("bigint")


def sum_partials(records: DataFrame) -> DataFrame:
    """Sums of each conversation, nulls where no record has a value."""
    return records.groupBy(*GROUP_KEYS).agg(*record_sums())


def cell_partials(records: DataFrame) -> DataFrame:
    """Port cells of each conversation, ``side`` telling source from destination."""
    sides = F.array(
        *[F.struct(F.lit(port).alias("side"), F.col(port).cast("string").alias("port")) for port in _PORTS]
    )
    ported = records.select(*GROUP_KEYS, F.inline(sides))
    return port_cells(ported, [*GROUP_KEYS, "side"], "port").select(*GROUP_KEYS, *CELL, "side")


@dataclass(frozen=True)
class PartialStore:
    """Partials below one folder: ``sums`` and ``cells``, by day and batch."""

    folder: str

    def add(self, records: DataFrame, batch: str | int) -> None:
        """Store the partials of a batch; once more with the same name replaces them.

        The records are derived once, and what both tables need of them is kept meanwhile.
        """
        kept = records.select(*GROUP_KEYS, *_SUMMED, *_PORTS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, partials in (("sums", sum_partials(kept)), ("cells", cell_partials(kept))):
                path = f"{self.folder}/{name}/{_BATCH}={batch}"
                partials.withColumn(_DAY, _day()).write.mode("overwrite").partitionBy(_DAY).parquet(path)
        finally:
            kept.unpersist()

    def _read(self, spark: SparkSession, name: str, since: int | None) -> DataFrame:
        found = spark.read.option("basePath", f"{self.folder}/{name}").parquet(f"{self.folder}/{name}")
        if since is None:
            return found
        # The day prunes folders, the time the rows of the first of them.
        return found.where((F.col(_DAY) >= since // DAY_SECONDS) & (F.col("recordtime") > since))

    def features(
        self, spark: SparkSession, since: int | None = None, label: str = "normal", lists: bool = True
    ) -> DataFrame:
        """Features of the conversations recorded after ``since``, as from their records."""
        sums = self._read(spark, "sums", since).groupBy(*GROUP_KEYS).agg(
            *[F.sum(name).alias(name) for name in _SUMS]
        )
        cells = self._read(spark, "cells", since)
        joined = sums
        for port, (count, listed) in _PORTS.items():
            merged = merge_cells(cells.where(F.col("side") == port), GROUP_KEYS)
            wanted = [count_of_ports().alias(count)] + ([list_of_ports().alias(listed)] if lists else [])
            found = merged.groupBy(*GROUP_KEYS).agg(*wanted)
            same = [F.col(f"_left.{key}").eqNullSafe(F.col(f"_right.{key}")) for key in GROUP_KEYS]
            joined = (
                joined.alias("_left").join(found.alias("_right"), same, "left")
                .select("_left.*", *[F.col(f"_right.{name}") for name in found.columns if name not in GROUP_KEYS])
            )
        nothing = {count: F.coalesce(F.col(count), F.lit(0.0)) for count, _ in _PORTS.values()}
        if lists:
            nothing |= {listed: F.coalesce(F.col(listed), F.lit("")) for _, listed in _PORTS.values()}
        return (
            joined.withColumns(nothing).withColumns(protocol_flags()).withColumn("label", F.lit(label)).select(
                "srcip", "dstip", "recordtime", "proto", "label", *FEATURE_COLUMNS,
                *[listed for _, listed in _PORTS.values() if lists],
            )
        )

    def compact(self, spark: SparkSession, into: PartialStore, batch: str = "merged") -> None:
        """The same partials with one row for each conversation, and cell, in another store."""
        sums = self._read(spark, "sums", None).groupBy(*GROUP_KEYS, _DAY).agg(
            *[F.sum(name).alias(name) for name in _SUMS]
        )
        cells = merge_cells(self._read(spark, "cells", None), [*GROUP_KEYS, _DAY, "side"])
        for name, merged in (("sums", sums), ("cells", cells)):
            merged.write.mode("overwrite").partitionBy(_DAY).parquet(f"{into.folder}/{name}/{_BATCH}={batch}")
