"""Vectorised word and line segmentation with 64-bit hashes over Arrow string columns.

A batch of texts is handled as one byte buffer: separators are found by table lookup, and a
word's hash is a polynomial over its bytes taken from one running sum, so no Python string is
made per word.  All functions work on whole texts; null counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[[0x0A, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(maxsize=4)
def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return values[LOWER] if lower else values


class Words:
    """Words of a run of documents: byte ``start``/``end``, 64-bit ``hash`` and per-document ``offsets``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
        self.data, self.bounds, self.start, self.end, self.hash = data, bounds, start, end, hashes
        self.offsets = np.searchsorted(start, bounds)
        self.offsets[-1] = len(start)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def texts(self, doc: int) -> list[bytes]:
        raw = self.data.tobytes() if len(self) == 1 else self.data[self.bounds[doc] : self.bounds[doc + 1]].tobytes()
        base = self.bounds[doc]
        lo, hi = self.offsets[doc], self.offsets[doc + 1]
        return [raw[a:b] for a, b in zip((self.start[lo:hi] - base).tolist(), (self.end[lo:hi] - base).tolist())]


def segment(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray, lower: bool) -> Words:
    """Maximal separator-free runs inside each document of a byte buffer."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, bounds, none, none, np.zeros(0, np.uint64))
    inside = ~(separators[LOWER] if lower else separators)[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(max(CHUNK_BYTES, 1 << (n - 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(lower)[data] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return Words(data, bounds, start, end, hashes)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of consecutive rows of at most ``chunk_bytes``, or one longer row."""
    data, offsets = _buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_chunks(column: pa.Array, separators: np.ndarray, lower: bool = False) -> Iterator[tuple[int, Words]]:
    for row, _, data, bounds in chunks(column):
        yield row, segment(data, bounds, separators, lower)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive values (order counts); empty when there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for i in range(k):
        out += h[i : i + n] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    return mix(out)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, reach = h, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[: len(out) - step], out[step:])
        reach += step
    return out


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of ``k``-word shingles; fewer words count as one whole sequence."""
    if not len(h):
        return h
    return np.unique(grams(h, k) if len(h) >= k else mix(grams(h, len(h)) + np.uint64(len(h))))
