"""Models judged by the order of their scores: exact ranks, ROC area, best threshold.

Equal scores are one step of the curve and share the mean of their ranks. Scores
are counted first, then added up in their order by ranges, so no task sees all rows
and ties of any size are one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvigil.operators.ranks import running_totals


def score_steps(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """``score, n_pos, n_neg, pos_upto, neg_upto``: each different score and what is at or below it.

    ``positive`` is a boolean column. Rows whose score or label is null or whose
    score is NaN are left out.
    """
    steps = (
        scored.select(F.col(score).cast("double").alias("score"), F.col(positive).cast("boolean").alias("positive"))
        .where("score is not null and not isnan(score) and positive is not null")
        .groupBy("score")
        .agg(F.count_if("positive").alias("n_pos"), F.count_if(~F.col("positive")).alias("n_neg"))
    )
    return running_totals(
        steps, [F.col("score")], {"pos_upto": F.col("n_pos"), "neg_upto": F.col("n_neg")}
    )


def mean_ranks(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """``score, n_pos, n_neg, rank``: the rank from below that rows of each score share."""
    total = F.col("pos_upto") + F.col("neg_upto")
    own = F.col("n_pos") + F.col("n_neg")
    steps = score_steps(scored, score, positive)
    return steps.select("score", "n_pos", "n_neg", (total - own + (own + 1) / 2).alias("rank"))


def rank_evaluation(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """One row: ``n_pos, n_neg, area, threshold, f1, true_pos, false_pos``.

    ``area`` is the share of pairs of a positive and a negative row in which the
    positive one has the higher score, ties counted half; null without both kinds.
    Rows at or above ``threshold`` are taken for positive; it is the one with the
    highest F1, of equal ones the highest threshold.
    """
    steps = score_steps(scored, score, positive)
    all_of = steps.agg(F.sum("n_pos").alias("all_pos"), F.sum("n_neg").alias("all_neg")).first()
    all_pos, all_neg = all_of["all_pos"] or 0, all_of["all_neg"] or 0
    true_pos = F.lit(all_pos) - F.col("pos_upto") + F.col("n_pos")
    false_pos = F.lit(all_neg) - F.col("neg_upto") + F.col("n_neg")
    f1 = 2.0 * true_pos / (true_pos + false_pos + F.lit(all_pos))
    won = F.col("n_pos").cast("decimal(38,0)") * (2 * F.col("neg_upto") - F.col("n_neg"))
    best = F.max(F.struct(f1.alias("f1"), "score", true_pos.alias("tp"), false_pos.alias("fp"))).alias("best")
    summed = steps.agg(F.sum(won).alias("won"), best)
    pairs = 2.0 * all_pos * all_neg
    return summed.select(
        F.lit(all_pos).cast("bigint").alias("n_pos"),
        F.lit(all_neg).cast("bigint").alias("n_neg"),
        (F.col("won").cast("double") / F.lit(pairs) if pairs else F.lit(None).cast("double")).alias("area"),
        F.col("best.score").alias("threshold"),
        F.col("best.f1").alias("f1"),
        F.col("best.tp").alias("true_pos"),
        F.col("best.fp").alias("false_pos"),
    )
