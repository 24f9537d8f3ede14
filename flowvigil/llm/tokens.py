"""Words of many texts at once: spans and hashes over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: Bytes that belong to words: letters, digits and all of UTF-8 beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = True
WORD_BYTES[128:] = True

#: Bytes that are not ASCII white space.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first, past last, their UTF-8 bytes and the offsets in these. Null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of member bytes; none crosses the end of a text."""
    inside = members[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owners(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text of each position."""
    return np.searchsorted(offsets, starts, "right") - 1


class Powers:
    """Powers of the hash base and of its inverse, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, from which any span of the bytes can be hashed."""
    up, _ = _POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, equal for equal bytes wherever they stand."""
    _, down = _POWERS.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the first word of each."""
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total + words[k : len(words) - n + 1 + k])
    whole = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
    return total[whole], whole


def member_of(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions in a sorted array, or -1."""
    if not len(sorted_values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at, -1)
