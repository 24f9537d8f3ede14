"""Row limits, splits and class balance without a funnel through one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Copies of one row that a task makes at a time.
COPY_BLOCK = 1024
#: Up to so many labels go to every task; rows of more labels are shuffled to them.
BROADCAST_LABELS = 100_000
#: Rows on the edge of a sample that are ranked together, unless their keys are equal.
EDGE_ROWS = 100_000
#: Hexadecimal digits of the key hash that are counted at a time.
DIGITS = 4


def _key_hash(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys]))


def take_rows(df: DataFrame, number: int, keys: Sequence[str]) -> DataFrame:
    """``number`` rows, the same ones on every run: first by hash of a unique key.

    A plain ``limit`` brings all its rows into one partition. Here the counts of
    hash prefixes (65,536 at most) say which belong whole, and the prefix on the
    edge is counted by its next digits until few rows are left to be ranked. The
    input is read more than once and has to give the same rows each time.
    """
    order = [F.col("_hash"), *[F.col(key) for key in keys]]
    hashed = df.withColumn("_hash", _key_hash(keys))
    left, edge, below = number, "", []
    while True:
        digits = len(edge) + DIGITS
        counts = (
            hashed.where(F.col("_hash").startswith(edge))
            .groupBy(F.substring("_hash", 1, digits).alias("prefix"))
            .count()
            .orderBy("prefix")
            .collect()
        )
        over = None
        for row in counts:
            if row["count"] > left:
                over = row
                break
            left -= row["count"]
        if over is None:
            return df
        below.append((digits, over["prefix"], edge))
        edge = over["prefix"]
        if over["count"] <= EDGE_ROWS or digits >= 32:
            break
    whole = F.lit(False)
    for digits, prefix, inside in below:
        whole |= F.col("_hash").startswith(inside) & (F.substring("_hash", 1, digits) < prefix)
    on_edge = F.col("_hash").startswith(edge)
    rank = F.row_number().over(Window.orderBy(*order))
    partly = hashed.where(on_edge).withColumn("_rank", rank).where(F.col("_rank") <= left).drop("_rank")
    return hashed.where(whole).unionByName(partly).drop("_hash")


def hash_split(df: DataFrame, percent: int, keys: Sequence[str]) -> DataFrame:
    """Add ``in_sample`` for about ``percent`` of 100 rows, fixed by the key."""
    bucket = F.conv(F.substring(_key_hash(keys), 1, 4), 16, 10).cast("int") % 100
    return df.withColumn("in_sample", bucket < percent)


def random_split(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    sample, rest = df.randomSplit([share, 1.0 - share], seed)
    return sample, rest


def class_copies(rows: DataFrame, portscan_by_flood: bool = False) -> DataFrame:
    """``label, copies``: how often the largest class holds each class.

    ``portscan_by_flood`` divides by the FLOOD count for PORTSCAN too, which
    reproduces sample sets that were built that way. A join with few labels takes
    them to the rows: shuffled by label, the largest class would be one task's.
    """
    counts = rows.groupBy("label").count()
    is_flood = F.col("label") == "FLOOD"
    sizes = counts.agg(
        F.max("count").alias("largest"),
        F.max(F.when(is_flood, F.col("count"))).alias("flood"),
        F.count(F.lit(1)).alias("labels"),
    ).first()
    divisor = F.col("count")
    if portscan_by_flood and sizes["flood"] is not None:
        divisor = F.when(F.col("label") == "PORTSCAN", F.lit(sizes["flood"])).otherwise(divisor)
    copies = F.floor(F.lit(sizes["largest"]) / divisor).cast("bigint")
    found = counts.select("label", F.col("count").alias("n"), copies.alias("copies"))
    return F.broadcast(found) if sizes["labels"] <= BROADCAST_LABELS else found


def oversample(
    rows: DataFrame, portscan_by_flood: bool = False, copies: DataFrame | None = None
) -> DataFrame:
    """Repeat the rows of each class until it nears the size of the largest.

    The rows join the copies of their label, null included, however many labels
    there are. Copies are made in blocks that are dealt to the tasks before they
    are expanded, so the rows of a rare class do not expand inside a single task.
    """
    copies = class_copies(rows, portscan_by_flood) if copies is None else copies
    wanted = copies.select(F.col("label").alias("_label"), F.col("copies").alias("_copies"))
    joined = rows.join(wanted.where("_copies > 0"), F.col("label").eqNullSafe(F.col("_label")))
    last = F.floor((F.col("_copies") - 1) / COPY_BLOCK).cast("bigint")
    blocks = joined.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    dealt = blocks.repartition(F.xxhash64(*[F.col(name) for name in rows.columns]), F.col("_block"))
    here = F.least(F.col("_copies") - F.col("_block") * COPY_BLOCK, F.lit(COPY_BLOCK)).cast("int")
    repeated = dealt.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), here)))
    return repeated.select(*rows.columns)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def attack_training_set(
    attacks: DataFrame,
    normal: DataFrame,
    keys: Sequence[str],
    normal_per_attack: int = 5,
    portscan_by_flood: bool = False,
) -> DataFrame:
    """Balanced attacks, and up to five times as many normal rows.

    Both inputs are read more than once: pass stored feature tables.
    """
    copies = class_copies(attacks, portscan_by_flood)
    balanced = oversample(attacks, copies=copies)
    attack_rows = copies.agg(F.sum(F.col("n") * F.col("copies"))).first()[0] or 0
    chosen = take_rows(normal, attack_rows * normal_per_attack, keys)
    return chosen.unionByName(balanced)


def netflow_training_set(
    parts: Sequence[DataFrame], normal: DataFrame, normal_percent: int, keys: Sequence[str]
) -> DataFrame:
    """Attack sets and a sample of the normal rows."""
    sampled = hash_split(normal, normal_percent, keys).where("in_sample").drop("in_sample")
    return union_all([*parts, sampled])
