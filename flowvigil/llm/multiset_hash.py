"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph (a line of the text) is hashed to a wide vector; the fingerprint
is their sum, lane by lane, modulo powers of two: 2^16 for the strong lanes, 2^32
for the sketch, whose counts no text of less than 2 GB makes wrap. So the order of paragraphs
does not matter, and a paragraph is inserted or deleted by adding or subtracting
its vector, without the rest of the text.

A vector has STRONG lanes from a cryptographic hash of the paragraph, which tell
multisets apart, and SKETCH lanes that count its runs of three words with random
signs. Sums of the latter estimate how much two texts share: the likeness is
``2 a.b / (a.a + b.b)`` over them, 1 for equal fingerprints, near 0 for texts
without common runs.

Defined cases: a null or empty text has no paragraph and the zero vector; blank
lines are paragraphs; a paragraph of one or two words counts its words. Two
fingerprints of texts without words are alike if they are equal. Rows are in
order of id, null ids first, rows with one id in order of their text's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm import tokens as tk

STRONG = 64
SKETCH = 128
#: A vector in memory: the sketch as 32-bit counts, then the strong lanes, two to a word.
LANES = SKETCH + STRONG // 2
RUN = 3
#: Characters of text that a task fingerprints at a time.
CHUNK = 2 << 20

_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def _strong(paragraphs: list[bytes]) -> np.ndarray:
    hashed = b"".join([hashlib.shake_128(paragraph).digest(2 * STRONG) for paragraph in paragraphs])
    return np.frombuffer(hashed, "<u2").reshape(-1, STRONG)


def _vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of paragraph vectors: a row per text."""
    n = len(offsets) - 1
    out = np.zeros((n, LANES), np.uint32)
    strong = np.zeros((n, STRONG), np.uint16)
    if not len(data):
        return out
    starts, ends = tk.word_spans(data, offsets, _NOT_NEWLINE)
    owner = tk.owners(starts, offsets)
    raw = data.tobytes()
    if len(starts):
        lanes = _strong([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        strong[owner[first]] = np.add.reduceat(lanes, first, axis=0, dtype=np.uint16)
    breaks = np.bincount(tk.owners(np.flatnonzero(data == 10), offsets), minlength=n)
    blank = breaks + (np.diff(offsets) > 0) - np.bincount(owner, minlength=n)
    strong += blank[:, None].astype(np.uint16) * _strong([b""])
    word_start, word_end = tk.word_spans(data, offsets, tk.NOT_BLANK)
    hashes = tk.span_hashes(tk.prefix_sums(data), word_start, word_end)
    paragraph = np.searchsorted(starts, word_start, "right") - 1
    runs, at = tk.gram_hashes(hashes, paragraph, RUN)
    short = np.flatnonzero(np.bincount(paragraph, minlength=len(starts))[paragraph] < RUN)
    hashed = np.concatenate([runs, tk.mix(hashes[short])])
    place = np.concatenate([at, short])
    lane = owner[paragraph[place]] * SKETCH + (hashed & np.uint64(SKETCH - 1)).astype(np.int64)
    sign = np.where(hashed & np.uint64(SKETCH), 1.0, -1.0)
    out[:, :SKETCH] = np.bincount(lane, sign, n * SKETCH).astype(np.int64).astype(np.uint32).reshape(n, SKETCH)
    out[:, SKETCH:] = strong.view(np.uint32)
    return out


def fingerprint_vectors(texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), LANES), np.uint32)
    for at, to, data, offsets in tk.slices(pa.array(texts, pa.large_string())):
        out[at:to] = _vectors(data, offsets)
    return out


def to_text(vectors: np.ndarray) -> list[str]:
    return [row.astype("<u4").tobytes().hex() for row in vectors]


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), "<u4").astype(np.uint32)


def combine(left: np.ndarray, right: np.ndarray, sign: int = 1) -> np.ndarray:
    """Sums (or differences) of vectors, each lane modulo its power of two."""
    out = left + right if sign > 0 else left - right
    ours, theirs = (np.ascontiguousarray(x[..., SKETCH:]).view(np.uint16) for x in (left, right))
    out[..., SKETCH:] = (ours + theirs if sign > 0 else ours - theirs).view(np.uint32)
    return out


def insert(fingerprint: str, paragraph: str) -> str:
    """The fingerprint with one paragraph more; ``paragraph`` has no line break."""
    return to_text(combine(from_text(fingerprint), _of_paragraph(paragraph))[None, :])[0]


def delete(fingerprint: str, paragraph: str) -> str:
    """The fingerprint with one paragraph less."""
    return to_text(combine(from_text(fingerprint), _of_paragraph(paragraph), -1)[None, :])[0]


def _of_paragraph(paragraph: str) -> np.ndarray:
    if not paragraph:
        vector = np.zeros(LANES, np.uint32)
        vector[SKETCH:] = _strong([b""])[0].view(np.uint32)
        return vector
    return fingerprint_vectors([paragraph])[0]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of rows."""
    a, b = (x[:, :SKETCH].astype(np.int32).astype(np.float64) for x in (left, right))
    norm = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    near = np.where(norm > 0, 2 * (a * b).sum(axis=1) / np.maximum(norm, 1), 0.0)
    same = (left == right).all(axis=1)
    return np.where(same, 1.0, np.clip(near, 0.0, 1.0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of each text as lowercase hex."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        out: list[str] = []
        for _, _, data, offsets in tk.slices(texts):
            out += to_text(_vectors(data, offsets))
        return pa.array(out, pa.string())

    return run(text)


def _ranges(documents: DataFrame) -> tuple[list[int], int]:
    """Bounds that cut the ids into as many ranges as a shuffle has partitions."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    found = documents.approxQuantile("id", shares, 0.2 / parts) if shares else []
    return sorted({int(x) for x in found}), parts


def with_next_text(documents: DataFrame, text: str = "text") -> DataFrame:
    """Rows ``id, text, own``, each range of ids in one partition and in order.

    The last row of a partition is not its own but the first of the next range
    (after the last range: of the first), so each own row is followed by the
    next document. One shuffle of the texts; of each range one text travels twice.
    """
    spark = documents.sparkSession
    slim = documents.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id"), "doc_id", F.col(text).alias("text")
    )
    bounds, parts = _ranges(slim.select("id"))

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, ids.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    ranged = slim.withColumn("part", range_of("id"))
    # One row per range, and there are as many as partitions of a shuffle.
    firsts = sorted(
        (row["part"], row["first"])
        for row in ranged.groupBy("part").agg(F.min("id").alias("first")).collect()
    )
    lent = [(firsts[k - 1][0], first) for k, (_, first) in enumerate(firsts)]
    lends = spark.createDataFrame(lent, "part int, id bigint")
    borrowed = slim.join(F.broadcast(lends), "id").select(
        "id", "doc_id", "text", "part", F.lit(False).alias("own")
    )
    both = ranged.withColumn("own", F.lit(True)).unionByName(borrowed)
    dealt = both.repartitionById(parts, F.col("part"))
    return dealt.sortWithinPartitions(
        F.col("part"), F.col("own").desc(), F.col("id"), F.xxhash64("text")
    ).select("doc_id", "text", "own")


def fingerprint_edits(documents: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of each text, and of the text with its end exchanged.

    The last half of the code points (rounded down) gives way to the first as
    many of the next document. Returns ``doc_id, n_chars, fingerprint,
    edited_sha256, edited_fingerprint, near_edited, near_next``.
    """
    rows = with_next_text(documents, text)
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("n_chars", T.LongType()),
            *[T.StructField(name, T.StringType()) for name in ("fingerprint", "edited_sha256", "edited_fingerprint")],
            *[T.StructField(name, T.DoubleType()) for name in ("near_edited", "near_next")],
        ]
    )
    kind = _arrow_type(documents.schema["doc_id"].dataType)

    def finish(ids: list, texts: list[str]) -> pa.RecordBatch:
        """``texts`` has one more: what follows the last."""
        edited = [
            own[: len(own) - len(own) // 2] + after[: len(own) // 2]
            for own, after in zip(texts[:-1], texts[1:], strict=True)
        ]
        prints, others = fingerprint_vectors(texts), fingerprint_vectors(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, kind),
                pa.array([len(x) for x in texts[:-1]], pa.int64()),
                pa.array(to_text(prints[:-1])),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                pa.array(to_text(others)),
                pa.array(likeness(prints[:-1], others)),
                pa.array(likeness(prints[:-1], prints[1:])),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, over = [], [], 0, False
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for doc_id, value, own in rows:
                if over:
                    continue
                texts.append(value or "")
                size += len(texts[-1])
                if not own:
                    over = True
                    yield finish(ids, texts)
                    continue
                if size > CHUNK and ids:
                    yield finish(ids, texts)
                    ids, texts = [], texts[-1:]
                    size = len(texts[0])
                ids.append(doc_id)

    return rows.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
