"""Mixing sources to target weights by entropy balancing.

Each source gets a share of all words by weight, at most ``cap`` times its own
size. Document rates then solve: stay as near as possible (in relative entropy)
to one copy of each document, no rate over ``cap``, and the words of each source
add up to its target. The solution is an exponential tilt,
``rate = min(cap, exp(multiplier * size / mean size))``, with one multiplier per
source, the maximiser of a concave dual. Newton iterations find it: the gradient
and the curvature are sums over documents, taken by Spark over a histogram of
(source, size), which is far smaller than the documents and exact. A step that
leaves the bracket known so far is replaced by its middle.

Rows that agree in id, source and size are told apart by nothing that the mix
reads, so they are counted before the shuffle and come back, in blocks that are
dealt to the buckets, when their copies are decided: an id or a missing id that
many rows share does not fill one bucket.

Rates become copies within buckets of some thousand rows of a source, from the
longest document to the shortest: a document takes the higher of its two counts
if the words owed so far make up half of it. A bucket ends within a short
document of its share, and a source of any size is split over tasks.

All sums that steer the result are exact (decimals and integers), so reruns
agree whatever order the tasks end in.

Defined cases: a null text has size 0; sources that are null are one source,
last in order; a source without words has target 0; documents without words keep
rate 1 (or ``cap`` if their whole source is taken ``cap`` times) and take 0
words; repeated rows are documents of their own. Other columns are ignored. If the
iteration ends before every source is near its target, a warning says by how much.
"""

from __future__ import annotations

import math
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvigil.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4096
#: Equal rows are dealt to the buckets in blocks of this many.
BLOCK_ROWS = 256
#: Newton stops when every source is this near its target, as a share of it.
TOLERANCE = 1e-7
MAX_STEPS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _source_key(source: Column) -> Column:
    """Equal for equal sources, null included, and never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(sources: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Add ``target`` to ``key, source, source_size, documents, worded``.

    One row per source; the order of sources is global, so these rows meet in one
    task. Filling up by weight with limits has a closed form: in order of
    limit / weight, a source is at its limit if its limit is under its share of
    what the sources before it leave.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_source) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)) + 1)
    ranked = sources.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * F.lit(cap))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_limit") / F.col("_weight"), "key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    filled = (
        ranked.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_used", F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_gone", F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_total") - F.col("_used")) / (F.col("_weights") - F.col("_gone")))
        .withColumn("_full", F.col("_limit") <= F.col("_weight") * F.col("_level"))
    )
    # The level of the first source below its limit is that of all below theirs.
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("_weight"), F.col("key"), F.col("_level")))).over(everything)
    target = F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_weight") * level["_level"])
    return filled.select(*sources.columns, target.alias("target"), F.col("_full").alias("full"))


def _rate(multiplier: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(multiplier * x, F.lit(50.0))))


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,9)")


def solve_multipliers(histogram: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Newton on the dual: ``sources`` with ``multiplier``; null where all rates are ``cap``.

    ``histogram`` has ``key, size, n``. The state has a row per source and stays a
    table; the driver sees the largest error only.
    """
    mean = F.col("source_size") / F.greatest(F.col("worded"), F.lit(1))
    state = stored(
        sources.withColumn("mean", F.greatest(mean, F.lit(1.0)))
        .withColumn("multiplier", F.when(~F.col("full"), F.lit(0.0)))
        .withColumn("low", F.lit(None).cast("double"))
        .withColumn("high", F.lit(None).cast("double"))
        .withColumn("error", F.when(~F.col("full"), F.lit(1.0)).otherwise(F.lit(0.0))),
        "multipliers",
    )
    for step in range(MAX_STEPS + 1):
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
        if step == MAX_STEPS:
            warnings.warn(f"entropy balancing: a source is {worst:.2g} of its target away from it", stacklevel=2)
            break
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), x, cap)
        free = F.when(rate < cap, rate * x * x * F.col("n")).otherwise(F.lit(0.0))
        sums = (
            histogram.join(
                state.where("multiplier is not null").select("key", "mean", "multiplier"), "key"
            )
            .groupBy("key")
            .agg(
                F.sum(_exact(rate * x * F.col("n"))).cast("double").alias("_words"),
                F.sum(_exact(free)).cast("double").alias("_bend"),
            )
        )
        at, goal = F.col("multiplier"), F.col("target") / F.col("mean")
        gap = F.col("_words") - goal
        low = F.when(gap < 0, at).otherwise(F.col("low"))
        high = F.when(gap > 0, at).otherwise(F.col("high"))
        moved = (
            state.join(sums, "key", "left")
            .withColumn("_gap", gap)
            .withColumn("low", low)
            .withColumn("high", high)
            .withColumn("_step", at - F.when(F.col("_bend") > 0, F.col("_gap") / F.col("_bend")))
        )
        inside = (
            F.col("_step").isNotNull()
            & (F.col("low").isNull() | (F.col("_step") > F.col("low")))
            & (F.col("high").isNull() | (F.col("_step") < F.col("high")))
            & (F.abs(F.col("_step") - at) <= 1 + F.abs(at))
        )
        middle = (
            F.when(F.col("high").isNull(), F.greatest(at * 2, at + 1))
            .when(F.col("low").isNull(), F.least(at * 2, at - 1))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        done = F.coalesce(F.abs(F.col("_gap")) <= goal * TOLERANCE, F.lit(True))
        state = stored(
            moved.withColumn("error", F.when(done, F.lit(0.0)).otherwise(F.abs(F.col("_gap")) / goal))
            .withColumn(
                "multiplier",
                F.when(done, at).when(inside, F.col("_step")).otherwise(middle),
            )
            .select(*state.columns),
            "multipliers",
        )
    return state.drop("low", "high", "error")


def mix_sources(
    documents: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    cap: int = 3,
    text: str = "text",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` of every row."""
    sized = stored(
        documents.select(
            "doc_id", "source", _source_key(F.col("source")).alias("key"), word_count(F.col(text)).alias("size")
        )
        .groupBy("doc_id", "source", "key", "size")
        .agg(F.count("*").alias("n")),
        "sizes",
    )
    histogram = stored(sized.groupBy("key", "source", "size").agg(F.sum("n").alias("n")), "histogram")
    totals = histogram.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum("n").alias("documents"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("worded"),
    )
    solved = solve_multipliers(histogram, source_targets(totals, weights, float(cap)), float(cap))
    rate = F.when(F.col("multiplier").isNull(), F.lit(float(cap))).otherwise(
        _rate(F.col("multiplier"), F.col("size") / F.col("mean"), float(cap))
    )
    per_source = solved.select("key", "source_size", "target", "documents", "mean", "multiplier")
    blocks = F.sequence(F.lit(0), F.expr(f"(n - 1) div {BLOCK_ROWS}").cast("int"))
    rated = (
        sized.join(per_source, "key")
        .withColumn("rate", F.round(rate, 9))
        .withColumn("block", F.explode(blocks))
        .withColumn("rows", F.least(F.lit(BLOCK_ROWS), F.col("n") - F.col("block") * BLOCK_ROWS).cast("int"))
        .withColumn("hash", F.xxhash64("doc_id", "size", "block"))
        .withColumn("bucket", F.pmod(F.col("hash"), F.ceil(F.col("documents") / BUCKET_ROWS)))
        .select(
            "doc_id", "source", "size", F.col("source_size").cast("bigint").alias("source_size"),
            "target", "rate", "key", "hash", "bucket", "rows",
        )
    )
    out = rated.drop("key", "hash", "bucket", "rows").schema.add("copies", "long").add("taken", "long")
    return rated.groupBy("key", "bucket").applyInPandas(lambda bucket: round_rates(bucket, cap), out)


def round_rates(rows: pd.DataFrame, cap: int) -> pd.DataFrame:
    """Copies of a bucket's documents, each line standing for ``rows`` of them.

    The words still owed decide between two counts.
    From the longest document to the shortest; then, in the same order, a document
    gets one copy more or less if that brings the bucket nearer to what it owes.
    """
    rows = rows.loc[rows.index.repeat(rows["rows"])]
    rows = rows.sort_values(["size", "hash", "doc_id"], ascending=[False, True, True])
    sizes, rates = rows["size"].tolist(), rows["rate"].tolist()
    copies, owed = [], 0.0
    for size, rate in zip(sizes, rates, strict=True):
        low = math.floor(rate)
        owed += (rate - low) * size
        more = rate > low and owed >= size / 2
        copies.append(low + more)
        owed -= size * more
    for k, size in enumerate(sizes):
        step = 1 if owed > 0 else -1
        if 0 <= copies[k] + step <= cap and abs(owed - step * size) < abs(owed):
            copies[k] += step
            owed -= step * size
    rows["copies"] = copies
    rows["taken"] = rows["copies"] * rows["size"]
    return rows.drop(columns=["key", "hash", "bucket", "rows"])
