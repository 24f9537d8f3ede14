"""Word vectors from counts: the vocabulary is a table, the driver holds none of it.

Words that stand near one another are counted, and the counts become positive
pointwise mutual information, a sparse symmetric table ``(word, context, weight)``.
Its leading eigenvectors are found by a randomised range finder: the table times
random signs, which every task derives from the words themselves, then a few
rounds of multiplication, each a join and a grouped sum. What reaches the driver
are square matrices of as many rows as a vector has dimensions.

Defined cases: a null or empty list of words has no pairs, and a text without a
known word the zero vector; words seen fewer than ``min_count`` times are left
out; with fewer words than dimensions the last dimensions are zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.session import work_folder


@dataclass(frozen=True)
class CountedEmbedding:
    """``extra`` dimensions are searched beside those kept; each of ``rounds``
    multiplications brings the search closer to the leading eigenvectors."""

    size: int = 64
    window: int = 5
    min_count: int = 5
    extra: int = 8
    rounds: int = 2
    seed: int = 42

    @property
    def width(self) -> int:
        return self.size + self.extra


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again: what several passes read is made once."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _unordered_pairs(texts: DataFrame, words: str, window: int) -> DataFrame:
    """``word, context, n`` with each pair once, under its lesser word; a word beside itself counts twice."""
    apart = texts.select(
        F.col(words).alias("_words"), F.explode(F.sequence(F.lit(1), F.lit(window))).alias("_d")
    ).where(F.size("_words") > F.col("_d"))
    length = F.size("_words") - F.col("_d")
    beside = F.arrays_zip(
        F.slice("_words", F.lit(1), length).alias("word"),
        F.slice("_words", F.col("_d") + 1, length).alias("context"),
    )
    pairs = apart.select(F.inline(beside)).where("word is not null and context is not null")
    once = pairs.groupBy(
        F.least("word", "context").alias("word"), F.greatest("word", "context").alias("context")
    ).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("word") == F.col("context")
    return once.withColumn("n", F.when(same, F.col("n") * 2).otherwise(F.col("n")))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Each row, and the same with word and context exchanged if they differ."""
    rest = [name for name in pairs.columns if name not in ("word", "context")]
    given = F.struct("word", "context", *rest)
    turned = F.struct(F.col("context").alias("word"), F.col("word").alias("context"), *rest)
    same = F.col("word") == F.col("context")
    return pairs.select(F.inline(F.when(same, F.array(given)).otherwise(F.array(given, turned))))


def pair_counts(texts: DataFrame, words: str, window: int) -> DataFrame:
    """``word, context, n``: places at most ``window`` apart that hold the two words, both ways."""
    return _both_ways(_unordered_pairs(texts, words, window))


def frequent_words(texts: DataFrame, words: str, min_count: int) -> DataFrame:
    counted = texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & F.col("word").isNotNull()).select("word")


def positive_information(pairs: DataFrame) -> DataFrame:
    """``word, context, weight`` of pairs that stand together more often than by chance.

    The sums of words are joined to the pairs from either side; both joins have a
    shuffle of their own below them, so one that holds a very frequent word is split.
    """
    sums = pairs.groupBy("word").agg(F.sum("n").cast("double").alias("total"))
    whole = float(pairs.agg(F.sum("n")).first()[0] or 0)
    return _weighed(pairs, sums, whole)


def _weighed(pairs: DataFrame, sums: DataFrame, whole: float) -> DataFrame:
    left = sums.select("word", F.col("total").alias("of_word")).repartition(F.xxhash64("word"))
    right = sums.select(F.col("word").alias("context"), F.col("total").alias("of_context")).repartition(
        F.xxhash64("context")
    )
    joined = pairs.join(left, "word").join(right, "context")
    weight = F.log(F.col("n") * F.lit(whole) / (F.col("of_word") * F.col("of_context")))
    return joined.select("word", "context", weight.alias("weight")).where("weight > 0")


def _vocabulary(texts: DataFrame, words: str) -> tuple[DataFrame, int]:
    """``word, id`` of every word, the ids being hashes of a seed that tells all words apart; and the seed."""
    listed = _stored(texts.select(F.explode(words).alias("word")).where("word is not null").distinct(), "words")
    seed = 42
    while True:
        numbered = listed.select("word", F.xxhash64("word", F.lit(seed)).alias("id"))
        if numbered.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return numbered, seed
        seed += 1


def word_information(texts: DataFrame, words: str, window: int) -> DataFrame:
    """``word, contexts, information``: how many words stand near it more often than by
    chance, and the sum of their weights in whole thousandths, rounded down.

    Pairs are counted once and under numbers, which keep the rows of the two joins short;
    both ways of a pair weigh the same, so the joins see it once.
    """
    vocabulary, seed = _vocabulary(texts, words)
    number = F.transform(words, lambda word: F.when(word.isNotNull(), F.xxhash64(word, F.lit(seed))))
    pairs = _stored(_unordered_pairs(texts.select(number.alias("ids")), "ids", window), "pairs")
    sums = _stored(
        _both_ways(pairs).groupBy("word").agg(F.sum("n").cast("double").alias("total")), "sums"
    )
    whole = float(sums.agg(F.sum("total")).first()[0] or 0)
    weights = _both_ways(_weighed(pairs, sums, whole))
    told = weights.groupBy("word").agg(
        F.count(F.lit(1)).alias("contexts"), F.sum(F.floor(F.col("weight") * 1000)).alias("information")
    )
    return vocabulary.join(told.withColumnRenamed("word", "id"), "id").select("word", "contexts", "information")


def _lanes(width: int) -> list[str]:
    return [f"v{k}" for k in range(width)]


def _random_sign(word: Column, lane: int, seed: int) -> Column:
    bits = F.xxhash64(word, F.lit(seed + lane // 64))
    return F.lit(1.0) - F.shiftrightunsigned(bits, lane % 64).bitwiseAND(F.lit(1)) * 2


def _matrix(batch: pa.RecordBatch, lanes: Sequence[str]) -> np.ndarray:
    columns = [batch.column(batch.schema.get_field_index(lane)).to_numpy(zero_copy_only=False) for lane in lanes]
    return np.stack(columns, axis=1) if len(batch) else np.empty((0, len(lanes)))


def _product(rows: DataFrame, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The transpose of some columns times others: a small matrix, summed up by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(left), len(right)))
        for batch in batches:
            total += _matrix(batch, left).T @ _matrix(batch, right)
        row, column = np.indices(total.shape)
        cells = [pa.array(part.ravel()) for part in (row, column, total)]
        yield pa.RecordBatch.from_arrays(cells, names=["row", "column", "value"])

    parts = rows.select(*dict.fromkeys([*left, *right])).mapInArrow(run, "row bigint, column bigint, value double")
    out = np.zeros((len(left), len(right)))
    for cell in parts.groupBy("row", "column").agg(F.sum("value").alias("value")).collect():
        out[cell["row"], cell["column"]] = cell["value"]
    return out


def _turned(rows: DataFrame, lanes: Sequence[str], by: np.ndarray) -> DataFrame:
    """``word`` and the lanes times a small matrix."""
    out = _lanes(by.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = _matrix(batch, lanes) @ by
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(new[:, k]) for k in range(by.shape[1])]], names=["word", *out]
            )

    schema = "word string, " + ", ".join(f"{lane} double" for lane in out)
    return rows.select("word", *lanes).mapInArrow(run, schema)


def _orthonormal(rows: DataFrame, lanes: Sequence[str]) -> DataFrame:
    """An orthonormal basis of the lanes; directions that are not there become zero."""
    values, vectors = np.linalg.eigh(_product(rows, lanes, lanes))
    there = values > 1e-12 * max(values.max(initial=0.0), 1e-300)
    scale = np.where(there, 1 / np.sqrt(np.where(there, values, 1.0)), 0.0)
    return _turned(rows, lanes, vectors * scale)


def _times(weights: DataFrame, vectors: DataFrame, lanes: Sequence[str]) -> DataFrame:
    """The table of weights times vectors of its contexts."""
    of_context = vectors.withColumnRenamed("word", "context").repartition(F.xxhash64("context"))
    joined = weights.join(of_context, "context")
    return joined.groupBy("word").agg(*[F.sum(F.col("weight") * F.col(lane)).alias(lane) for lane in lanes])


def counted_vectors(texts: DataFrame, words: str, settings: CountedEmbedding | None = None) -> DataFrame:
    """``word, vector``: eigenvectors of the information table, scaled by the roots of their values."""
    settings = settings or CountedEmbedding()
    lanes = _lanes(settings.width)
    pairs = pair_counts(texts, words, settings.window)
    if settings.min_count > 1:
        known = frequent_words(texts, words, settings.min_count)
        pairs = pairs.join(known, "word", "left_semi").join(
            known.withColumnRenamed("word", "context"), "context", "left_semi"
        )
    weights = _stored(positive_information(_stored(pairs, "pairs")), "weights")
    signs = [_random_sign(F.col("context"), k, settings.seed) for k in range(settings.width)]
    start = weights.groupBy("word").agg(
        *[F.sum(F.col("weight") * sign).alias(lane) for lane, sign in zip(lanes, signs, strict=True)]
    )
    basis = _stored(_orthonormal(_stored(start, "range"), lanes), "basis")
    for _ in range(settings.rounds):
        basis = _stored(_orthonormal(_stored(_times(weights, basis, lanes), "range"), lanes), "basis")
    moved = [f"m{lane}" for lane in lanes]
    image = _times(weights, basis, lanes).select("word", *[F.col(a).alias(b) for a, b in zip(lanes, moved, strict=True)])
    both = _stored(basis.join(image, "word"), "image")
    small = _product(both, lanes, moved)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    # No direction of the basis that is zero has a value.
    leading = np.argsort(-np.abs(values), kind="stable")[: settings.size]
    turned = _turned(both, lanes, vectors[:, leading] * np.sqrt(np.abs(values[leading])))
    return turned.select("word", F.array(*_lanes(len(leading))).alias("vector"))


def text_vectors(
    texts: DataFrame, key: str, words: str, vectors: DataFrame, size: int, name: str = "words2vec"
) -> DataFrame:
    """``key`` (unique) and the mean vector of the known words of each text.

    A word is counted within its text before it meets its vector; vectors are
    unique, so a join with a frequent word can be split.
    """
    counted = texts.select(key, F.explode(words).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    dealt = vectors.repartition(F.xxhash64("word"))
    sums = counted.join(dealt, "word").groupBy(key).agg(
        *[F.sum(F.col("n") * F.get("vector", F.lit(k))).alias(f"v{k}") for k in range(size)], F.sum("n").alias("_n")
    )
    mean = F.array(*[F.coalesce(F.col(f"v{k}") / F.col("_n"), F.lit(0.0)) for k in range(size)])
    return texts.select(key).join(sums, key, "left").select(key, array_to_vector(mean).alias(name))
