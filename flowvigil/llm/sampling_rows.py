"""Bounded samples of labelled rows, chosen by hash: the same rows on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the smallest hash of the key.

    Hashes are uniform, so a threshold by label leaves about twice as many rows
    before the exact cut; no label's rows meet in one task. The counts are sent to
    the tasks: a row per label, and the labels are classes of a model that the
    driver holds.
    """
    order = F.xxhash64(F.col(key)).cast("double") / float(1 << 64) + 0.5
    counts = rows.groupBy(label).count().withColumnRenamed(label, "_label")
    marked = rows.withColumn("_order", order).join(F.broadcast(counts), F.col(label) == F.col("_label"))
    few = marked.where(F.col("_order") <= 2.0 * per_label / F.col("count") + 20.0 / F.col("count"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_order", key))
    kept = few.withColumn("_rank", rank).where(F.col("_rank") <= per_label)
    return kept.drop("_label", "_order", "count", "_rank")
