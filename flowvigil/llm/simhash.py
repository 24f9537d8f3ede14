"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 or 128 bits is cut into segments; the number of set bits of each is a
point of an integer grid. The Manhattan distance of two points is at most the
Hamming distance of their fingerprints, so all links of ``radius`` bits are
within that distance on the grid. Over parts of the segments the distance adds
up: with ``parts`` parts, one of them has at most ``radius // parts``, which is
two here. Two points at most two apart share a cell if each enters its own cell
and those next to it. So: every fingerprint enters those cells of each part,
fingerprints that meet in a cell are verified exactly on all bits, and no
link is missed.

Linked fingerprints form components; a cell gives one edge for each fingerprint
that hangs together with another in it, not all pairs. Cells that many
fingerprints enter (a family of near copies) are cut into blocks, and each pair
of blocks is a group of its own.

Finer segments make emptier cells: two bits suit some hundred million distinct
fingerprints, one bit more. The answer is the same.

Defined cases: texts are split at ASCII white space after A-Z are lower-cased; a
text of fewer than ``width`` words is one shingle; a null or blank text has the
fingerprint zero, linked like any other. Repeated rows each get their row.
Null ids are ignored when the smallest id of a component is sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm.store import connected_components, stored
from flowvigil.llm.tokens import mix

#: Hashes whose bits are counted at a time.
SLICE = 1 << 16
#: A fingerprint takes 64 bits from hashes of the first seed, 64 more from the second.
SEEDS = (42, 43)
#: A cell whose own fingerprints number more than this is cut into blocks.
HEAVY = 512
BLOCK = 4096
#: Rows of a larger group that are compared with the rest of it at a time.
ROWS = 128
#: Runs up to this length are compared pair by pair in one vector operation.
SHORT = 8


def shingles(text: str | None, width: int) -> list[bytes]:
    """The shingles of a text, repeats included, as UTF-8."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < width:
        return [joined]
    ends = np.cumsum(np.fromiter((len(word) + 1 for word in words), np.int64, len(words)))
    starts = [0, *ends[: len(words) - width].tolist()]
    return [joined[i : j - 1] for i, j in zip(starts, ends[width - 1 :].tolist(), strict=True)]


def shingle_hashes(pieces: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(piece, seed) for piece in pieces], np.uint64)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def text_fingerprints(texts: list[str | None], width: int, seeds: tuple[int, ...] = SEEDS[:1]) -> np.ndarray:
    """Fingerprints of texts, 64 bits for each seed: a row per seed.

    A bit is set if over half of the shingle hashes have it.
    """
    out = np.zeros((len(seeds), len(texts)), np.uint64)
    waiting: list[np.ndarray] = []
    rows: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not waiting:
            return
        counts = np.array([x.shape[1] for x in waiting])
        at = np.concatenate([[0], np.cumsum(counts)[:-1]])
        for k, hashes in enumerate(np.concatenate(waiting, axis=1)):
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
            out[k, rows] = _pack(sums * 2 > counts[:, None])
        waiting.clear()
        rows.clear()
        size = 0

    for row, text in enumerate(texts):
        pieces = shingles(text, width)
        if not pieces:
            continue
        hashes = np.stack([shingle_hashes(pieces, seed) for seed in seeds])
        if len(pieces) > SLICE:
            out[:, row] = [_pack((_set_bits(one) * 2 > len(one))[None, :])[0] for one in hashes]
            continue
        waiting.append(hashes)
        rows.append(row)
        size += len(pieces)
        if size >= SLICE:
            flush()
    flush()
    return out


def node_of(prints: np.ndarray) -> np.ndarray:
    """One number per fingerprint: itself, or a hash of its two words."""
    return prints[0] if len(prints) == 1 else mix(prints[0] + mix(prints[1]))


def _columns(prints: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(word).view(np.int64)) for word in prints]


def _names(words: int) -> list[str]:
    return [f"fp{k}" for k in range(words)]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def fingerprints(documents: DataFrame, width: int = 4, words: int = 1, text: str = "text") -> DataFrame:
    """``doc_id, node, fp0`` (and ``fp1``), signed longs, of every row."""
    slim = documents.select("doc_id", F.col(text).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], *_longs("node", *_names(words))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_fingerprints(batch.column(1).to_pylist(), width, SEEDS[:words])
            columns = _columns(np.stack([node_of(found), *found]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return slim.mapInArrow(run, schema)


def parts_for(radius: int) -> int:
    """The fewest parts of which one is at most two apart."""
    return radius // 3 + 1


def part_bits(parts: int, words: int) -> list[tuple[int, int]]:
    edges = [64 * words * k // parts for k in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _bits(prints: np.ndarray, at: int, width: int) -> np.ndarray:
    """Bits ``at`` to ``at + width`` of fingerprints, over the edge of a word if need be."""
    word, shift = divmod(at, 64)
    piece = prints[word] >> np.uint64(shift)
    if shift + width > 64:
        piece = piece | (prints[word + 1] << np.uint64(64 - shift))
    return piece & np.uint64((1 << width) - 1)


def embed(prints: np.ndarray, low: int, high: int, segment_bits: int) -> np.ndarray:
    """Set bits of each segment of bits ``low`` to ``high``: a row per fingerprint."""
    columns = [
        np.bitwise_count(_bits(prints, at, min(segment_bits, high - at)))
        for at in range(low, high, segment_bits)
    ]
    return np.stack(columns, axis=1).astype(np.int64)


def cells(prints: np.ndarray, part: int, bits: tuple[int, int], segment_bits: int, near: bool):
    """Rows and cell numbers: each fingerprint's own cell and, if ``near``, those next to it.

    A count takes two bits of the number, or one for segments of one bit; the
    part takes the highest.
    """
    low, high = bits
    counts = embed(prints, low, high, segment_bits)
    field = 1 if segment_bits == 1 else 2
    weight = np.int64(1) << (np.arange(counts.shape[1], dtype=np.int64) * field)
    own = counts @ weight
    rows, found = [np.arange(prints.shape[1])], [own]
    if near:
        for k in range(counts.shape[1]):
            most = min(segment_bits, high - low - k * segment_bits)
            for step in (-1, 1):
                fits = np.flatnonzero((counts[:, k] + step >= 0) & (counts[:, k] + step <= most))
                rows.append(fits)
                found.append(own[fits] + step * weight[k])
    return np.concatenate(rows), np.concatenate(found) | (np.int64(part) << np.int64(58))


def _read(batch: pa.RecordBatch, first: int, words: int) -> np.ndarray:
    return np.stack(
        [batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(first, first + words)]
    )


def _enter(prints: DataFrame, words: int, radius: int, segment_bits: int, near: bool) -> DataFrame:
    spans = part_bits(parts_for(radius), words)
    schema = T.StructType(_longs("cell", *_names(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = _read(batch, 0, words)
            for part, bits in enumerate(spans):
                rows, found = cells(fp, part, bits, segment_bits, near)
                yield pa.RecordBatch.from_arrays([pa.array(found), *_columns(fp[:, rows])], names=schema.names)

    return prints.select(*_names(words)).mapInArrow(run, schema)


def _neighbour_cells(cell: np.ndarray, words: int, radius: int, segment_bits: int) -> np.ndarray:
    """All numbers one step from given cells; some are no cells, and nothing enters those."""
    field = 1 if segment_bits == 1 else 2
    most = max(-(-(high - low) // segment_bits) for low, high in part_bits(parts_for(radius), words))
    out = [cell]
    for k in range(most):
        step = np.int64(1) << np.int64(k * field)
        out += [cell + step, cell - step]
    return np.concatenate(out)


def _heavy_cells(prints: DataFrame, words: int, radius: int, segment_bits: int) -> DataFrame:
    """``cell, blocks`` of cells next to one that more than HEAVY fingerprints call their own."""
    crowded = (
        _enter(prints, words, radius, segment_bits, near=False)
        .groupBy("cell")
        .count()
        .where(F.col("count") > HEAVY)
    )
    schema = T.StructType(_longs("cell", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            near = _neighbour_cells(cell, words, radius, segment_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near), pa.array(np.tile(n, len(near) // max(1, len(cell))))], names=["cell", "n"]
            )

    spread = crowded.mapInArrow(run, schema).groupBy("cell").agg(F.sum("n").alias("n"))
    return spread.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits; the first axis is the words of a fingerprint."""
    out = np.bitwise_count(left[0] ^ right[0])
    for a, b in zip(left[1:], right[1:], strict=True):
        out = out + np.bitwise_count(a ^ b)
    return out


def _linked(fp: np.ndarray, rows: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    return _apart(fp[:, rows, None], fp[:, None, others]) <= radius


def _together(fp: np.ndarray, radius: int) -> np.ndarray:
    """For each of a group's fingerprints the first that it hangs together with.

    Some rows at a time are compared with all that are left. Those without a link
    leave; from the first with one, its whole component is walked and leaves.
    A family of near copies leaves in a few steps, however large it is.
    """
    label = np.arange(fp.shape[1])
    left = label
    while len(left) > 1:
        linked = _linked(fp, left[:ROWS], left, radius)
        if np.count_nonzero(linked) == len(linked):
            left = left[ROWS:]
            continue
        found = np.flatnonzero(linked.sum(axis=1) > 1)
        if not len(found):
            left = left[ROWS:]
            continue
        first = left[found[0]]
        member = linked[found[0]]
        # Rows before the first with a link have none.
        member[: found[0]] = True
        front = left[linked[found[0]] & (np.arange(len(left)) > found[0])]
        label[front] = first
        left = left[~member]
        while len(front) and len(left):
            near = _linked(fp, front[:ROWS], left, radius).any(axis=0)
            label[left[near]] = first
            front = np.concatenate([front[ROWS:], left[near]])
            left = left[~near]
    return label


def _group_edges(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as pairs of nodes, among rows with equal key, which are next to each other."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    size_of = np.repeat(sizes, sizes)
    node = node_of(fp)
    a, b = [node[:0]], [node[:0]]
    short = np.flatnonzero((size_of <= SHORT) & (size_of > 1))
    k_short, f_short, n_short = key[short], fp[:, short], node[short]
    for gap in range(1, SHORT):
        if len(k_short) <= gap:
            break
        same = np.flatnonzero(k_short[gap:] == k_short[:-gap])
        hit = same[_apart(f_short[:, same + gap], f_short[:, same]) <= radius]
        a.append(n_short[hit + gap])
        b.append(n_short[hit])
    for start, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist(), strict=True):
        own, first = np.unique(node[start : start + size], return_index=True)
        label = _together(fp[:, start + first], radius)
        moved = label != np.arange(len(own))
        a.append(own[moved])
        b.append(own[label[moved]])
    return np.concatenate(a), np.concatenate(b)


def linked_fingerprints(prints: DataFrame, words: int, radius: int, segment_bits: int) -> DataFrame:
    """``a, b``: edges between nodes that join every two fingerprints ``radius`` bits apart or nearer."""
    if segment_bits not in (1, 2, 3):
        raise ValueError("segments have one to three bits")
    names = _names(words)
    entered = _enter(prints, words, radius, segment_bits, near=True)
    heavy = _heavy_cells(prints, words, radius, segment_bits)
    block = F.pmod(F.xxhash64(*names), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)).alias("other")
    grouped = (
        entered.join(heavy, "cell", "left")
        .select("cell", *names, F.coalesce(block, F.lit(0)).alias("block"), "blocks", other)
        .select(
            F.when(F.coalesce("blocks", F.lit(1)) == 1, F.col("cell"))
            .otherwise(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")))
            .alias("key"),
            *names,
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_key, kept_fp = np.empty(0, np.int64), np.empty((words, 0), np.uint64)
        for batch in batches:
            key = np.concatenate([kept_key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([kept_fp, _read(batch, 1, words)], axis=1)
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            kept_key, kept_fp = key[whole:], fp[:, whole:]
            yield _edge_batch(*_group_edges(key[:whole], fp[:, :whole], radius))
        if len(kept_key):
            yield _edge_batch(*_group_edges(kept_key, kept_fp, radius))

    by_key = grouped.repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(run, T.StructType(_longs("a", "b"))).distinct()


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
    )


def simhash_components(
    documents: DataFrame,
    width: int = 4,
    words: int = 1,
    radius: int = 4,
    segment_bits: int = 2,
    text: str = "text",
) -> DataFrame:
    """``doc_id, fp0`` (and ``fp1``), ``component_id`` of every row: the smallest id that links reach."""
    names = _names(words)
    marked = stored(fingerprints(documents, width, words, text), "fingerprints")
    least = stored(marked.groupBy("node", *names).agg(F.min("doc_id").alias("least")), "prints")
    roots = connected_components(linked_fingerprints(least, words, radius, segment_bits))
    rooted = least.join(roots, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    )
    smallest = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "component").select("node", "component_id")
    return marked.join(classes, "node").select("doc_id", *names, "component_id")
