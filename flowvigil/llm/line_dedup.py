"""Repeated three-line windows: the first occurrence stays, later ones lose their lines.

Every run of three consecutive lines of a document is a window. Windows are equal
if their lines are. Occurrences are ordered by (doc_id, line number); all but the
first are removed, that is, the lines that they cover, windows overlapping.
Windows are judged on the input, not on what is left.

Defined cases: a null text has no lines and stays null; a text of one or two
lines has no window and stays whole; windows of blank lines only are no windows;
null ids come first; rows with one id, or with none, have one place in the order,
so of two equal rows both stay whole, but each row loses only lines that its own
text repeats; lines of a repeat inside a document go like any other. Other columns
are carried along, whatever their names, but for those this operator adds.

Scale: each line is hashed where it is read. Windows are counted with map-side
aggregation, only repeated ones are joined back to their positions, and both
sides of that join have a shuffle of their own, so a window that a third of the
documents share is split by adaptive execution. Only hashes are shuffled, and the
texts once, for the removal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _windows(lines: Column) -> Column:
    """``array<struct<line, a, b>>``; two 64-bit hashes tell windows apart."""
    starts = F.when(
        F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - F.lit(WINDOW))
    ).otherwise(F.array().cast("array<int>"))
    line = lambda i, k: F.get(lines, i + F.lit(k))
    hashed = F.transform(
        starts,
        lambda i: F.struct(
            i.alias("line"),
            F.xxhash64(line(i, 0), line(i, 1), line(i, 2)).alias("a"),
            F.xxhash64(F.lit("second"), line(i, 2), line(i, 0), line(i, 1)).alias("b"),
            (F.trim(F.concat(line(i, 0), line(i, 1), line(i, 2))) == "").alias("blank"),
        ),
    )
    return F.filter(hashed, lambda window: ~window["blank"])


def window_occurrences(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, own, line, a, b``: a row per window; ``own`` is a hash of the row's text."""
    lines = documents.select(
        "doc_id", F.xxhash64(F.col(text)).alias("own"), F.split(F.col(text), "\n", -1).alias("lines")
    )
    windows = lines.select("doc_id", "own", F.explode(_windows(F.col("lines"))).alias("window"))
    return windows.select("doc_id", "own", "window.line", "window.a", "window.b")


def covered_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, own, covered``: the starts of windows to remove, for rows that have any."""
    occurrences = window_occurrences(documents, text)
    firsts = (
        occurrences.groupBy("a", "b")
        .agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first")
        # Dealt by a hash of the keys: the aggregate's own layout would spare the
        # join a shuffle on this side, and with it the split of a hot window.
        .repartition(F.xxhash64("ra", "rb"))
    )
    later = occurrences.join(firsts, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).where(
        ~(F.struct("doc_id", "line").eqNullSafe(F.col("first")))
    )
    return later.groupBy("doc_id", "own").agg(F.collect_set("line").alias("covered"))


def remove_repeated_windows(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``text`` shortened; adds ``n_lines`` and ``n_removed``.

    Columns of the input with an added name give way.
    """
    added = ("n_lines", "n_removed")
    covered = covered_lines(documents, text).select(F.col("doc_id").alias("of"), "own", "covered")
    whole = documents.select(F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"))
    old = F.col("row").getField(text)
    same_row = F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.xxhash64(old) == F.col("own"))
    joined = whole.join(covered, same_row, "left")
    lines = F.split(old, "\n", -1)
    gone = F.array_distinct(
        F.flatten(
            F.transform(
                F.coalesce(F.col("covered"), F.array().cast("array<int>")),
                lambda start: F.sequence(start, start + F.lit(WINDOW - 1)),
            )
        )
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    same = [
        F.when(F.size(gone) > 0, left).otherwise(old).alias(name) if name == text else F.col("row").getField(name).alias(name)
        for name in documents.columns
        if name not in added
    ]
    n_lines = F.when(old.isNull(), F.lit(0)).otherwise(F.size(lines))
    return joined.select(
        *same, n_lines.cast("bigint").alias("n_lines"), F.size(gone).cast("bigint").alias("n_removed")
    )
