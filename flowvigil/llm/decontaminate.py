"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Count, over all documents, the words that benchmark items use.
2. An n-gram of an item is rare, and a seed, if the product of its words'
   frequencies makes it unlikely in a document by chance. The measure is not the
   n-gram's own frequency, so an item that leaked into a third of the corpus
   keeps its seeds. An item whose rare n-grams are so few that one word may be in
   all of them gives every n-gram.
3. A scan of the documents finds seeds and cuts out passages: as far to each side
   as the item goes, and some words more. The seeds join passages to items.
4. Word-level local alignment scores every pair; edits, gaps and paraphrases
   lower the score step by step. ``similarity`` is the score over that of the
   whole item; a pair counts from ``threshold`` on, or from ``long_match``
   matching words on, which catches parts of long items.

Seeds are sent to the tasks in blocks of at most SEED_BLOCK, one scan a block, so
what is broadcast has a bound whatever the benchmark holds. Passages are shuffled,
whole texts are not.

Defined cases: null and empty texts and items have no words and match nothing;
an item with fewer than ``n`` words is one seed as a whole, found where it stands
as consecutive words; repeated rows count once in the result; null ids are
compared like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm import tokens as tk
from flowvigil.llm.store import stored

N = 3
#: Seeds that tasks hold at a time.
SEED_BLOCK = 1 << 20
#: Words of a benchmark that tasks count at a time.
WORD_BLOCK = 1 << 20
#: A seed is to be expected by chance in at most this share of documents.
CHANCE = 1e-3
MATCH, MISMATCH, GAP = 2, -1, -1
PAIRS = 256


def _words(texts: pa.Array):
    """Slices with word spans, hashes and owners of lower-cased texts."""
    for at, to, data, offsets in tk.slices(pc.utf8_lower(texts)):
        starts, ends = tk.word_spans(data, offsets, tk.WORD_BYTES)
        hashes = tk.span_hashes(tk.prefix_sums(data), starts, ends)
        yield at, to, data, starts, ends, hashes, tk.owners(starts, offsets)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def benchmark_grams(benchmark: DataFrame, n: int, text: str = "text") -> DataFrame:
    """``item_id, length, position, gram, words``: every n-gram of every item."""
    slim = benchmark.select("item_id", F.col(text).alias("text"))
    schema = T.StructType(
        [
            slim.schema["item_id"],
            T.StructField("length", T.IntegerType()),
            T.StructField("position", T.IntegerType()),
            T.StructField("gram", T.LongType()),
            T.StructField("words", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, to, _, _, _, hashes, owner in _words(batch.column(1)):
                for row in range(at, to):
                    own = hashes[owner == row - at]
                    width = min(n, len(own))
                    if not width:
                        continue
                    grams, first = tk.gram_hashes(own, np.zeros(len(own), np.int64), width)
                    for gram, k in zip(grams.view(np.int64).tolist(), first.tolist(), strict=True):
                        words = own[k : k + width].view(np.int64).tolist()
                        rows.append((row, len(own), k, gram, words))
            taken = pa.array([row[0] for row in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    pa.array([row[1] for row in rows], pa.int32()),
                    pa.array([row[2] for row in rows], pa.int32()),
                    pa.array([row[3] for row in rows], pa.int64()),
                    pa.array([row[4] for row in rows], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return slim.mapInArrow(run, schema)


def _blocks(values: DataFrame, size: int) -> Iterator[DataFrame]:
    """Parts of a stored frame with a column ``value`` of at most about ``size`` rows each."""
    n = values.count()
    parts = -(-n // size)
    for part in range(parts):
        yield values.where(F.pmod(F.xxhash64("value"), F.lit(parts)) == part)


def word_counts(documents: DataFrame, words: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: how often each given word hash stands in the documents; null: all words."""
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])
    slim = documents.select(F.col(text).alias("text"))
    total = None
    for k, block in enumerate(_blocks(words, WORD_BLOCK)):
        sought = np.sort(np.array([row[0] for row in block.collect()], np.int64).view(np.uint64))

        def run(
            batches: Iterator[pa.RecordBatch], sought: np.ndarray = sought, with_total: bool = k == 0
        ) -> Iterator[pa.RecordBatch]:
            counts, everything = np.zeros(len(sought), np.int64), 0
            for batch in batches:
                for _, _, _, _, _, hashes, _ in _words(batch.column(0)):
                    hit = tk.member_of(sought, hashes)
                    counts += np.bincount(hit[hit >= 0], minlength=len(sought))
                    everything += len(hashes)
            seen = np.flatnonzero(counts)
            word, n = sought[seen].view(np.int64).tolist(), counts[seen].tolist()
            if with_total:
                word, n = [*word, None], [*n, everything]
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(n, pa.int64())], names=schema.names)

        found = slim.mapInArrow(run, schema)
        total = found if total is None else total.unionByName(found)
    return total.groupBy("word").agg(F.sum("n").alias("n"))


def choose_seeds(grams: DataFrame, counts: DataFrame, documents: int, n: int = N) -> DataFrame:
    """The rare n-grams of each item, or all if one word may be in every rare one."""
    whole = counts.where("word is null").first()
    everything = max(1, whole["n"] if whole else 1)
    known = counts.where("word is not null")
    share = F.log((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(float(everything)))
    chance = (
        grams.withColumn("word", F.explode("words"))
        .join(known, "word", "left")
        .groupBy("item_id", "length", "position", "gram")
        .agg(F.sum(share).alias("chance"))
    )
    limit = float(np.log(CHANCE * max(1, documents) / everything))
    rare = F.col("chance") <= limit
    # A word stands in at most n n-grams at one place.
    n_rare = F.count(F.when(rare, 1)).over(Window.partitionBy("item_id"))
    return chance.withColumn("n_rare", n_rare).where(rare | (F.col("n_rare") <= n))


def find_passages(documents: DataFrame, reach: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], text: str) -> DataFrame:
    """``doc_id, start, words, grams``: word hashes around seeds.

    ``reach`` holds, per width of seeds in words, sorted seed hashes and how many
    words to take before and after each.
    """
    slim = documents.select("doc_id", F.col(text).alias("text"))
    schema = T.StructType(
        [
            slim.schema["doc_id"],
            T.StructField("start", T.IntegerType()),
            T.StructField("words", T.ArrayType(T.LongType())),
            T.StructField("grams", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, words, grams = [], [], [], []
            for at, _, _, _, _, hashes, owner in _words(batch.column(1)):
                first, low, high, gram = [], [], [], []
                for width, (seeds, before, after) in reach.items():
                    found, where = tk.gram_hashes(hashes, owner, width)
                    hit = tk.member_of(seeds, found)
                    at_seed = np.flatnonzero(hit >= 0)
                    first.append(where[at_seed])
                    low.append(where[at_seed] - before[hit[at_seed]])
                    high.append(where[at_seed] + after[hit[at_seed]])
                    gram.append(found[at_seed])
                first, low, high, gram = map(np.concatenate, (first, low, high, gram))
                order = np.lexsort((low, owner[first]))
                own_first = np.searchsorted(owner, owner[first], "left")
                own_end = np.searchsorted(owner, owner[first], "right")
                low, high = np.maximum(low, own_first), np.minimum(high, own_end)
                k = 0
                while k < len(order):
                    i = order[k]
                    doc, start, end, hits = owner[first[i]], low[i], high[i], {int(gram[i].view(np.int64))}
                    k += 1
                    while k < len(order) and owner[first[order[k]]] == doc and low[order[k]] <= end:
                        end = max(end, high[order[k]])
                        hits.add(int(gram[order[k]].view(np.int64)))
                        k += 1
                    rows.append(at + int(doc))
                    starts.append(int(start - own_first[i]))
                    words.append(hashes[start:end].view(np.int64))
                    grams.append(sorted(hits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int32()),
                    pa.array(words, pa.list_(pa.int64())),
                    pa.array(grams, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return slim.mapInArrow(run, schema)


def smith_waterman(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair, and where in the passage it ends (past the last word).

    All pairs advance together, an item word at a time; gaps along the passage
    come from a running maximum, gaps along the item from the row before.
    """
    width = max(len(x) for x in passages)
    passage = np.zeros((len(passages), width), np.int64)
    filled = np.zeros((len(passages), width), bool)
    for k, x in enumerate(passages):
        passage[k, : len(x)] = x
        filled[k, : len(x)] = True
    slope = np.arange(width, dtype=np.int32) * -GAP
    row = np.zeros((len(passages), width + 1), np.int32)
    best = np.zeros(len(passages), np.int32)
    end = np.zeros(len(passages), np.int64)
    for i in range(max(len(x) for x in items)):
        live = np.array([i < len(x) for x in items])
        word = np.array([x[i] if i < len(x) else 0 for x in items], np.int64)
        same = (passage == word[:, None]) & filled & live[:, None]
        here = np.maximum(row[:, :-1] + np.where(same, MATCH, MISMATCH), row[:, 1:] + GAP)
        here = np.maximum(here, 0)
        here = np.maximum.accumulate(here + slope, axis=1) - slope
        row[:, 1:] = here
        top = here.argmax(axis=1)
        value = here[np.arange(len(here)), top]
        better = value > best
        best[better] = value[better]
        end[better] = top[better] + 1
    return best, end


def align(pairs: DataFrame) -> DataFrame:
    """``doc_id, item_id, length, start, words, item_words`` to scored pairs."""
    schema = T.StructType(
        [
            pairs.schema["doc_id"],
            pairs.schema["item_id"],
            T.StructField("length", T.IntegerType()),
            T.StructField("score", T.IntegerType()),
            T.StructField("end_word", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            passage, item = (
                [np.asarray(x, np.int64) for x in batch.column(k).to_pylist()] for k in (4, 5)
            )
            start = batch.column(3).to_numpy(zero_copy_only=False)
            order = sorted(range(n), key=lambda k: (len(passage[k]), len(item[k])))
            score, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
            at = 0
            while at < n:
                most = max(1, min(PAIRS, (1 << 20) // max(1, len(passage[order[min(n, at + PAIRS) - 1]]))))
                group = order[at : at + most]
                score[group], end[group] = smith_waterman([item[k] for k in group], [passage[k] for k in group])
                at += most
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.array(score, pa.int32()), pa.array((start + end).astype(np.int32), pa.int32()),
                ],
                names=schema.names,
            )

    ordered = pairs.select("doc_id", "item_id", "length", "start", "words", "item_words")
    return ordered.mapInArrow(run, schema)


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.5,
    long_match: int = 50,
    n: int = N,
    text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, similarity, end_word`` of every contaminated document and its items."""
    grams = stored(benchmark_grams(benchmark, n, text), "grams")
    vocabulary = stored(
        grams.select(F.explode("words").alias("value")).distinct(), "vocabulary"
    )
    schema = T.StructType(
        [
            documents.schema["doc_id"], grams.schema["item_id"],
            T.StructField("score", T.IntegerType()), T.StructField("similarity", T.DoubleType()),
            T.StructField("end_word", T.IntegerType()),
        ]
    )
    if vocabulary.isEmpty():
        return documents.sparkSession.createDataFrame([], schema)
    counts = stored(word_counts(documents, vocabulary, text), "counts")
    seeds = stored(choose_seeds(grams, counts, documents.count(), n), "seeds")
    slack = F.ceil(F.col("length") * 0.2).cast("int") + 5
    reach = stored(
        seeds.groupBy(F.col("gram").alias("value"), F.least("length", F.lit(n)).alias("width")).agg(
            F.max(F.col("position") + slack).alias("before"),
            F.max(F.col("length") - F.col("position") + slack).alias("after"),
        ),
        "reach",
    )
    passages = None
    for block in _blocks(reach, SEED_BLOCK):
        held: dict[int, list] = {}
        for row in block.collect():
            held.setdefault(row["width"], []).append((row["value"], row["before"], row["after"]))
        arrays = {}
        for width, rows in held.items():
            value = np.array([row[0] for row in rows], np.int64).view(np.uint64)
            order = np.argsort(value)
            arrays[width] = (
                value[order],
                np.array([row[1] for row in rows], np.int64)[order],
                np.array([row[2] for row in rows], np.int64)[order],
            )
        found = find_passages(documents, arrays, text)
        passages = found if passages is None else passages.unionByName(found)
    passages = stored(passages.withColumn("passage", F.monotonically_increasing_id()), "passages")
    joined = (
        passages.select("doc_id", "passage", F.explode("grams").alias("gram"))
        .join(seeds.select("gram", "item_id", "length"), "gram")
        .select("passage", "item_id", "length")
        .distinct()
    )
    item_words = grams.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("position", "words"))).alias("g"))
    # The first word of every n-gram, and the rest of the last one.
    tail = F.element_at("g", -1)["words"]
    item_words = item_words.select(
        "item_id",
        F.concat(F.transform("g", lambda x: F.element_at(x["words"], 1)), F.slice(tail, 2, F.size(tail))).alias("item_words"),
    )
    pairs = (
        joined.join(passages.select("doc_id", "passage", "start", "words"), "passage")
        .join(item_words, "item_id")
    )
    scored = align(pairs).withColumn("similarity", F.col("score") / (MATCH * F.col("length")))
    hits = scored.where((F.col("similarity") >= threshold) | (F.col("score") >= MATCH * long_match))
    best = F.max(F.struct("score", "similarity", "end_word")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
