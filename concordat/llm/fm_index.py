"""A compressed FM-index over segments of words, with backward search in many lanes.

Suffixes are sorted by their first ``DEPTH`` words, which is enough for every
pattern of up to ``DEPTH`` words: a backward step only asks how many suffixes
precede an interval that is bounded at the pattern's own length. The BWT is a
wavelet matrix of packed bits with ranks by popcount.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n + 64) // 64 * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits, for each element."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class Wavelet:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.planes, self.zeros = bits, [], []
        cur = symbols
        for k in range(bits - 1, -1, -1):
            plane = (cur >> k) & 1 != 0
            low, high = cur[~plane], cur[plane]
            self.planes.append(Bits(plane))
            self.zeros.append(len(low))
            cur = np.concatenate((low, high))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i``, less where symbols below it start: an offset to :attr:`first`."""
        for p, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - p)) & 1 != 0
            ones = plane.ones(i)
            i = np.where(one, zeros + ones, i - ones)
        return i


class FMIndex:
    """Index of word sequences (``words`` cut at ``bounds``).

    ``window`` is the length of the patterns whose groups of suffixes can be
    looked up at once; it is at most ``DEPTH`` - 1.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray, window: int):
        if window >= DEPTH:
            raise ValueError(f"windows are shorter than {DEPTH} words")
        self.window = window
        self.values, ids = np.unique(words, return_inverse=True)
        k = len(bounds) - 1
        n = len(words) + k
        owner = np.repeat(np.arange(k), np.diff(bounds))
        place = np.arange(len(words)) + owner
        text = np.zeros(n, dtype=np.int64)  # 0 ends a segment
        text[place] = ids + 1
        self.owner = np.empty(n, dtype=np.int32)
        self.owner[place] = owner
        self.owner[bounds[1:] + np.arange(k)] = np.arange(k)
        self.n = n
        self._sort(text)
        bwt = text[self.sa - 1]
        self.bits = max(1, int(len(self.values)).bit_length())
        self.tree = Wavelet(bwt.astype(np.int32), self.bits)
        count = np.bincount(text, minlength=len(self.values) + 1)
        self.less = np.cumsum(count) - count
        # Where the wavelet matrix puts the first occurrence of each symbol.
        every = np.arange(len(self.values) + 1)
        self.base = self.tree.rank(every, np.zeros(len(every), dtype=np.int64))

    def _sort(self, text: np.ndarray) -> None:
        n, rank, h = self.n, text.astype(np.int32), 1
        kept = {1: rank} if self.window & 1 else {}  # the ranks that make up the window's length

        def shifted(r: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, dtype=np.int32)
            out[: max(n - by, 0)] = r[by:] + 1
            return out

        order = None
        while h < DEPTH:
            key = rank.astype(np.int64)
            key *= n + 2
            key += shifted(rank, h)
            order = np.argsort(key)
            key = key[order]
            new = np.empty(n, dtype=np.int32)
            new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1], dtype=np.int32)))
            rank, h = new, 2 * h
            if self.window & h:
                kept[h] = rank
        del key
        self.sa = order.astype(np.int32)
        # Suffixes that agree on the window's words, by the powers of two that it is made of.
        same, at = np.ones(n - 1, dtype=bool), 0
        for p in sorted(kept, reverse=True):
            r = (shifted(kept[p], at) if at else kept[p])[self.sa]
            same &= r[1:] == r[:-1]
            at += p
        self.starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
        self.ends = np.append(self.starts[1:], n)

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` followed by the patterns of ``lo``..``hi``."""
        shift = self.less[symbol] - self.base[symbol]
        return self.tree.rank(symbol, lo) + shift, self.tree.rank(symbol, hi) + shift

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; -1 for those that the index lacks."""
        i = np.searchsorted(self.values, words)
        i[i == len(self.values)] = 0
        return np.where(self.values[i] == words, i + 1, -1) if len(self.values) else np.full(len(words), -1)

    def count(self, pattern: np.ndarray) -> int:
        """Occurrences of a pattern of at most ``DEPTH`` words."""
        if len(pattern) > DEPTH:
            raise ValueError(f"a pattern has at most {DEPTH} words")
        lo, hi = np.array([0]), np.array([self.n])
        for s in self.symbols(pattern)[::-1]:
            if s < 0:
                return 0
            lo, hi = self.step(np.array([s]), lo, hi)
            if hi[0] <= lo[0]:
                return 0
        return int(hi[0] - lo[0])

    def groups(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each word of the streamed texts: the group of the window that starts there, or -1.

        Matching statistics cut off at the window's length. All texts go
        leftwards in step, a backward step a word; once a match is longer than
        the window, it is cut back to it by widening its interval to the group.
        Where a match breaks off, the search starts again one word earlier.
        """
        out = np.full(len(words), -1, dtype=np.int64)
        sym = self.symbols(words)
        begin, end = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
        pos = end.copy()
        lo, hi = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), self.n, dtype=np.int64)
        while True:
            live = (pos > begin) & (end - begin >= self.window)
            if not live.all():
                begin, end, pos, lo, hi = (x[live] for x in (begin, end, pos, lo, hi))
            if not len(pos):
                return out
            pos = pos - 1
            s = sym[pos]
            known = s >= 0
            lo, hi = self.step(np.where(known, s, 0), lo, hi)
            ok = known & (hi > lo)
            length = end - pos
            full = ok & (length >= self.window)
            if full.any():
                g = np.searchsorted(self.starts, lo[full], side="right") - 1
                out[pos[full]] = g
                lo[full], hi[full] = self.starts[g], self.ends[g]
                end[full] = pos[full] + self.window
            if not ok.all():
                bad = ~ok
                # An unknown word ends every window over it; else the last word goes.
                end[bad] = np.where(known[bad], end[bad] - 1, pos[bad])
                pos[bad] = end[bad]
                lo[bad], hi[bad] = 0, self.n

    def least(self, numbers: np.ndarray) -> np.ndarray:
        """The least of the segments' ``numbers`` in each group."""
        return np.minimum.reduceat(numbers[self.owner[self.sa]], self.starts)
