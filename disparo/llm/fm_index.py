"""A compressed FM-index over word ids: wavelet matrix of the Burrows-Wheeler transform.

Built for one shard of passages and searched by many patterns side by side (NumPy).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

NONE = np.iinfo(np.int64).max


class BitRank:
    """Bits in 64-bit words with a running count a word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))[:-1]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels, self.zeros = [], []
        x = symbols
        for d in range(self.depth - 1, -1, -1):
            bit = (x >> d) & 1
            self.levels.append(BitRank(bit))
            self.zeros.append(int(len(x) - bit.sum()))
            x = np.concatenate((x[bit == 0], x[bit == 1]))
        every = np.arange(alphabet)
        self.start = self._down(every, np.zeros(alphabet, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, zeros, d in zip(self.levels, self.zeros, range(self.depth - 1, -1, -1)):
            ones = level.ones(i)
            i = np.where((c >> d) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``c`` among the first ``i`` symbols."""
        return self._down(c, i) - self.start[c]


def suffix_array(first_rank: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank by the first ``depth`` symbols), ``depth`` a power of two, by prefix
    doubling.  Suffixes must differ (unique separators)."""
    n = len(first_rank)
    rank = first_rank.astype(np.int64)
    shallow, h = None, 1
    if depth == 1:
        shallow = rank
    while True:
        after = np.zeros(n, np.int64)
        after[:n - h] = rank[h:] + 1
        key = rank * np.int64(n + 1) + after
        order = np.argsort(key)
        fresh = np.empty(n, bool)
        fresh[0] = False
        sorted_key = key[order]
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        h *= 2
        if h == depth:
            shallow = rank
        if fresh[1:].all():
            return order, rank if shallow is None else shallow


class FMIndex:
    """Index of ``passages`` (id arrays, ids from 0) with an owner each; answers, for every
    window of ``window`` symbols of a pattern, the least owner of a passage that holds it."""

    def __init__(self, passages: Sequence[np.ndarray], owners: np.ndarray, alphabet: int, window: int):
        self.window, m = window, len(passages)
        lengths = np.array([len(p) for p in passages], np.int64)
        ends = np.cumsum(lengths + 1)
        n = int(ends[-1]) if m else 0
        self.n = n
        if not n:
            return
        text = np.zeros(n, np.int64)          # 0 is a separator, a word is its id + 1
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        text[inside] = np.concatenate(passages) + 1
        first = np.empty(n, np.int64)
        first[~inside] = np.arange(m)         # separators differ, and sort before words
        first[inside] = m - 1 + text[inside]
        used, dense = np.unique(first, return_inverse=True)
        depth = 1 << (window.bit_length() - 1)
        order, shallow = suffix_array(dense, depth)
        self.wavelet = WaveletMatrix(text[order - 1], alphabet + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet + 1))))
        # Suffixes with the same first ``window`` words are one block of the suffix array.
        late = np.full(n, -1, np.int64)
        late[:n - (window - depth)] = shallow[window - depth:]
        a, b = shallow[order], late[order]
        cut = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        owner_of = np.repeat(owners, lengths + 1)
        self.block = np.cumsum(cut) - 1
        self.least = np.minimum.reduceat(owner_of[order], np.flatnonzero(cut))

    def extend(self, c: np.ndarray, sp: np.ndarray, ep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the intervals of ``c`` followed by what ``[sp, ep)`` spells."""
        s = c + 1
        return self.before[s] + self.wavelet.rank(s, sp), self.before[s] + self.wavelet.rank(s, ep)

    def least_owners(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each position of the concatenated patterns: least owner of a passage that holds
        the window starting there (``NONE`` without one, or past a pattern's last window).

        All patterns run backward together.  A pattern keeps its right end while it can be
        extended; where it can't, the right end moves one word left and the search starts anew,
        which is the matching statistic of the next shorter end.  Ids below 0 occur nowhere."""
        out = np.full(len(flat), NONE, np.int64)
        if not self.n:
            return out
        begin, end = offsets[:-1].copy(), offsets[1:].copy()
        live = np.flatnonzero(end - begin >= self.window)
        begin, end = begin[live], end[live]
        at = end.copy()
        sp, ep = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        while len(at):
            c = flat[at - 1]
            lo, hi = self.extend(np.maximum(c, 0), sp, ep)
            good = (c >= 0) & (lo < hi)
            at = np.where(good, at - 1, at)
            sp, ep = np.where(good, lo, sp), np.where(good, hi, ep)
            full = good & (end - at >= self.window)
            out[at[full]] = self.least[self.block[sp[full]]]
            # A failed extension: no window ending here starts further left.
            end = np.where(good, end, end - 1)
            at = np.where(good, at, end)
            sp, ep = np.where(good, sp, 0), np.where(good, ep, self.n)
            keep = np.where(good, at > begin, end - begin >= self.window)
            if not keep.all():
                begin, end, at, sp, ep = begin[keep], end[keep], at[keep], sp[keep], ep[keep]
        return out
