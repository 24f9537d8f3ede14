"""Importance resampling towards a target distribution, over hashed word features.

Words come from an untrained pre-tokeniser, a Regex Split of the ``tokenizers``
library over the text with A-Z lower-cased; it returns each word with its
offsets. Windows of 1 to ``longest`` consecutive offset pairs are the features,
their words joined by one blank, and a feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``buckets``. One histogram counts the buckets of all documents, one
those of the target texts; a bucket's gain is the logarithm of how much more
frequent it is in the target, and a document's weight the mean of its gains.
Adding Gumbel noise to the weights and taking the highest draws documents without
replacement in proportion to the exponential of their weight.

Scale: the texts are split once, which leaves a document's buckets as packed
numbers; histograms are summed in each task before they are shuffled, a row per
bucket; the gains that the tasks look up have one number per bucket, whatever the
corpus. Ranks are exact and come from ranges of the scores, not from one task.

Defined cases: a null text has no words; a text without features has weight 0; a
null id is drawn by the noise of ``<seed>:``; repeated rows are documents of
their own, with equal scores and different ranks; texts without words in the
target give gains of smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from flowvigil.llm.store import stored
from flowvigil.operators.ranks import global_ranks

#: Bytes of text that are split at a time; a piece ends where no word goes on.
PIECE_BYTES = 1 << 20

#: All characters but ASCII other than digits and small letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_IN_WORD = np.ones(256, bool)
_IN_WORD[:128] = False
_IN_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True


@dataclass(frozen=True)
class Resampling:
    longest: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


def splitter() -> Split:
    """Keeps the words and drops what stands between them."""
    return Split(Regex(WORD), behavior="removed", invert=True)


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text in pieces that cut no word; no piece is longer than a word needs."""
    data = np.frombuffer(raw, np.uint8)
    at = 0
    while len(raw) - at > PIECE_BYTES:
        breaks = np.flatnonzero(~_IN_WORD[data[at : at + PIECE_BYTES]])
        to = at + int(breaks[-1]) + 1 if len(breaks) else None
        if to is None:
            after = np.flatnonzero(~_IN_WORD[data[at + PIECE_BYTES :]])
            to = at + PIECE_BYTES + int(after[0]) + 1 if len(after) else len(raw)
        yield raw[at:to]
        at = to
    yield raw[at:]


def word_offsets(split: Split, text: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of a lower-cased text, each with where it starts and ends."""
    return split.pre_tokenize_str(text)


def bucket_numbers(
    text: str | None, settings: Resampling, split: Split, known: dict[str, int]
) -> tuple[int, np.ndarray]:
    """The number of words and the bucket of each feature of a text; ``known`` keeps those of words."""
    found: list[int] = []
    n_words, carried = 0, ""
    for piece in _pieces((text or "").encode().lower()):
        plain = carried + piece.decode()
        words = word_offsets(split, plain)
        kept = settings.longest - 1
        fresh = sum(end > len(carried) for _, (_, end) in words)
        old = len(words) - fresh
        n_words += fresh
        for word, _ in words[old:]:
            number = known.get(word)
            if number is None:
                number = known[word] = zlib.crc32(word.encode()) % settings.buckets
            found.append(number)
        for length in range(2, settings.longest + 1):
            for k in range(max(0, old - length + 1), len(words) - length + 1):
                window = words[k : k + length]
                joined = " ".join(plain[a:b] for _, (a, b) in window)
                found.append(zlib.crc32(joined.encode()) % settings.buckets)
        carried = plain[words[-kept][1][0] :] if 0 < kept <= len(words) else (plain if kept else "")
    return n_words, np.array(found, np.uint32)


#: Words whose buckets a task keeps.
KNOWN = 1 << 18


def _packed(texts: DataFrame, settings: Resampling) -> DataFrame:
    """``doc_id, n_words, n_features, packed``: buckets as 32-bit numbers, or 16-bit ones that suffice."""
    kind = np.uint16 if settings.buckets <= 1 << 16 else np.uint32
    schema = T.StructType(
        [
            texts.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("packed", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = splitter(), {}
        for batch in batches:
            n_words, n_features, packed = [], [], []
            for text in batch.column(1):
                words, numbers = bucket_numbers(text.as_py(), settings, split, known)
                n_words.append(words)
                n_features.append(len(numbers))
                packed.append(numbers.astype(kind).tobytes())
                if len(known) > KNOWN:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                 pa.array(packed, pa.binary())],
                names=schema.names,
            )

    return texts.mapInArrow(run, schema)


def _histogram(packed: DataFrame, settings: Resampling) -> np.ndarray:
    """How often each bucket stands in all rows: the driver sees one number per bucket."""
    kind = np.uint16 if settings.buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for numbers in batch.column(0):
                total += np.bincount(np.frombuffer(numbers.as_buffer(), kind), minlength=settings.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = packed.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    out = np.zeros(settings.buckets, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much more frequent a bucket is in the target, rounded down."""
    n = len(source)
    ratio = ((target + 1) * float(source.sum() + n)) / ((source + 1) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(packed: DataFrame, gains: np.ndarray) -> DataFrame:
    """``weight`` of every row in place of its buckets."""
    kind = np.uint16 if len(gains) <= 1 << 16 else np.uint32
    schema = T.StructType([*packed.schema.fields[:3], T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for numbers in batch.column(3):
                own = np.frombuffer(numbers.as_buffer(), kind)
                weights.append(int(gains[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(3)] + [pa.array(weights, pa.int64())], names=schema.names
            )

    return packed.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document in thousandths, from a hash of its id: the same on every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    share = (drawn + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("bigint")


def importance_resample(
    documents: DataFrame, target: DataFrame, settings: Resampling | None = None, text: str = "text"
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null where it is not drawn.

    Drawn are ``percent`` of the documents with at least ``least_words`` words,
    those with the highest scores.
    """
    settings = settings or Resampling()
    packed = stored(_packed(documents.select("doc_id", F.col(text).alias("text")), settings), "buckets")
    wanted = _packed(target.select(F.lit(None).cast("bigint").alias("doc_id"), F.col(text).alias("text")), settings)
    gains = bucket_gains(_histogram(packed, settings), _histogram(wanted, settings))
    scored = stored(
        _weights(packed, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), settings.seed)),
        "scores",
    )
    enough = F.col("n_words") >= settings.least_words
    drawn = settings.percent * scored.where(enough).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("weight")]
    ranked = global_ranks(scored.where(enough), order)
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    kept = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", kept)
