"""Word vectors from counts, beside dense linear algebra."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from flowvigil.operators.embedding import (
    CountedEmbedding,
    counted_vectors,
    frequent_words,
    pair_counts,
    positive_information,
    text_vectors,
    word_information,
)

TEXTS = ["a b a a", "", None, "c", "b c d a b", "d d e a c b e", "a e a e b d c"]


def texts(spark):
    rows = [(k, text.split() if text is not None else None) for k, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, words array<string>")


def plain_pairs(window):
    counts = Counter()
    for text in TEXTS:
        words = (text or "").split()
        for i in range(len(words)):
            for j in range(len(words)):
                if 1 <= abs(i - j) <= window:
                    counts[words[i], words[j]] += 1
    return counts


def test_pairs_and_information(spark):
    for window in (1, 3):
        counts = plain_pairs(window)
        pairs = pair_counts(texts(spark), "words", window)
        assert {(r.word, r.context): r.n for r in pairs.collect()} == counts
        total, whole = Counter(), sum(counts.values())
        for (word, _), n in counts.items():
            total[word] += n
        lift = {key: n * whole / (total[key[0]] * total[key[1]]) for key, n in counts.items()}
        want = {key: np.log(value) for key, value in lift.items() if value > 1}
        got = {(r.word, r.context): r.weight for r in positive_information(pairs).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[key] - want[key]) < 1e-12 for key in want)


def test_word_information_counts_each_pair_once(spark):
    rows = texts(spark)
    for window in (1, 3):
        want = {}
        for r in positive_information(pair_counts(rows, "words", window)).collect():
            contexts, information = want.get(r.word, (0, 0))
            want[r.word] = (contexts + 1, information + int(np.floor(r.weight * 1000)))
        got = word_information(rows, "words", window)
        assert {r.word: (r.contexts, r.information) for r in got.collect()} == want
    # The texts are cut into pairs before the plan begins, not anew on each side of a join.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence" not in plan and "arrays_zip" not in plan


def test_frequent_words(spark):
    words = Counter(" ".join(text or "" for text in TEXTS).split())
    got = {r.word for r in frequent_words(texts(spark), "words", 5).collect()}
    assert got == {word for word, n in words.items() if n >= 5}


def test_vectors_are_the_leading_eigenvectors(spark):
    settings = CountedEmbedding(size=2, window=2, min_count=1, extra=16, rounds=1)
    got = {r.word: np.array(r.vector) for r in counted_vectors(texts(spark), "words", settings).collect()}
    names = sorted(got)
    weights = {(r.word, r.context): r.weight for r in positive_information(pair_counts(texts(spark), "words", 2)).collect()}
    dense = np.array([[weights.get((a, b), 0.0) for b in names] for a in names])
    values, vectors = np.linalg.eigh(dense)
    leading = np.argsort(-np.abs(values))[:2]
    want = vectors[:, leading] * np.sqrt(np.abs(values[leading]))
    ours = np.array([got[name] for name in names])
    for k in range(2):
        assert min(np.abs(ours[:, k] - want[:, k]).max(), np.abs(ours[:, k] + want[:, k]).max()) < 1e-6


def test_fewer_words_than_dimensions_and_no_words(spark):
    settings = CountedEmbedding(size=8, window=2, min_count=1, extra=2)
    few = spark.createDataFrame([(["x", "y"],), (["x", "x"],)], "words array<string>")
    got = counted_vectors(few, "words", settings).collect()
    assert all(len(r.vector) == 8 and np.isfinite(r.vector).all() for r in got)
    assert counted_vectors(few.limit(0), "words", settings).count() == 0


def test_mean_of_a_text(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, vector array<double>")
    means = text_vectors(texts(spark), "id", "words", vectors, 2).orderBy("id").collect()
    assert [r.id for r in means] == list(range(len(TEXTS)))
    for row, text in zip(means, TEXTS, strict=True):
        known = [word for word in (text or "").split() if word in "ab"]
        want = [known.count("a") / len(known), 3 * known.count("b") / len(known)] if known else [0, 0]
        assert np.allclose(row.words2vec.toArray(), want)


def test_the_joins_of_information_can_be_split(spark):
    pairs = spark.range(10).select(F.lit("a").alias("word"), F.col("id").cast("string").alias("context"), F.lit(1).alias("n"))
    plan = positive_information(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2
