"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvigil.session import work_folder


#: Spark's own setting: shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it again.

    Cuts the lineage and the cost of recomputing; a lost executor loses nothing.
    The shuffle files that the write needed are not kept.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """One round of large-star and small-star; edges are ``a > b``."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    large = (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )
    lowest = large.groupBy("a").agg(F.min("b").alias("low"))
    small = large.join(lowest, "a")
    return (
        small.select("a", F.col("low").alias("b"))
        .unionByName(small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` pairs to ``node, component``, the least node that can be reached.

    Alternating stars: a logarithmic number of rounds, whatever the shape. Each
    round is stored, only a count and a sum of hashes reach the driver. Nodes
    without an edge to another node are not returned.
    """
    state = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = state.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"),
        ).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        state = stored(_stars(state), "stars")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
