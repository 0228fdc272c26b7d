"""Vectorised word scanning over Arrow text batches (NumPy, no per-word Python).

A batch of texts is taken as the UTF-8 bytes of its Arrow buffer.  Words are maximal runs
of bytes of a 256-entry class table, which is exact for every word pattern that treats all
non-ASCII characters alike.  Each word gets a 64-bit hash from one prefix sum over the
bytes (a polynomial over random byte values), so no word is ever materialised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[int, np.ndarray] = {}

SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def non_space_class() -> np.ndarray:
    """Bytes of ``[^\\x20\\x09-\\x0D]+`` words."""
    t = np.ones(256, bool)
    t[list(SPACE_BYTES)] = False
    return t


def alnum_class() -> np.ndarray:
    """Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words (after lower-casing A-Z)."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        a = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        a[0] = 1
        have = np.multiply.accumulate(a)
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; NULL rows have length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], kind, count=len(col) + 1, offset=col.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``limit`` text bytes (a longer text is a slice alone),
    each with its text bytes and row offsets."""
    for batch in batches:
        at = 0
        data, off = text_buffers(batch.column(batch.schema.get_field_index(column)))
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at), data[off[at]:off[end]], off[at:end + 1] - off[at]
            at = end


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, equal for equal bytes."""
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power(_BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power(_INV, n + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions ``start[i] .. start[i] + count[i] - 1`` of all i, in order."""
    first = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(start - first, count)


class Words:
    """Words of a slice: ``start``/``end`` byte positions, ``first[r]:first[r+1]`` the words of
    row r, ``hash`` 64 bits a word."""

    __slots__ = ("start", "end", "first", "hash", "data")

    def __init__(self, data: np.ndarray, off: np.ndarray, word_class: np.ndarray, with_hash: bool = True):
        n = len(data)
        self.data = data
        inside = np.zeros(n + 1, bool)
        inside[:n] = word_class[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge))
        self.end = np.flatnonzero(before & (~inside | edge))
        self.first = np.searchsorted(self.start, off)
        self.hash = span_hash(data, self.start, self.end) if with_hash else None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def window_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (positions 0..n-k); row borders are the
    caller's care."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    m = U64(0xA0761D6478BD642F)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = acc * m + word_hash[j:j + n]
    return mix(acc ^ U64(k))


def mixed_sums(word_hash: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each run of words ``first[i]:last[i]`` of any length, from one prefix sum."""
    base, n = 0xE7037ED1A0B428DB, len(word_hash)
    if not len(first):
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * _power(base, n), out=total[1:])
    h = (total[last] - total[first]) * _power(pow(base, -1, 1 << 64), n + 1)[first]
    return mix(h + (last - first).astype(np.uint64))


def in_row(first: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """Whether the window of ``k`` words at each position 0..n-k stays inside its row."""
    n = n_words - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    counts = np.diff(first)
    left = np.repeat(first[1:], counts)[:n] - np.arange(n)
    return left >= k
