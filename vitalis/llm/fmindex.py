"""A compressed full-text index over word codes: BWT in a wavelet matrix, backward search in lockstep."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits with constant-time rank: 64-bit words and a count before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        """``symbols`` are below ``size``."""
        self.depth = max(1, int(size - 1).bit_length())
        self.levels = []
        for level in range(self.depth - 1, -1, -1):
            bits = ((symbols >> level) & 1).astype(np.uint8)
            self.levels.append(BitRank(bits))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.start = self.descend(np.arange(size), np.zeros(size, np.int64))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its place."""
        return self.descend(symbol, at) - self.start[symbol]


class FMIndex:
    """Index of texts (arrays of codes from 0), with the classes of suffixes that share ``depth`` first words."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, n_codes: int, depth: int):
        """Text j is ``codes[first[j]:first[j + 1]]``."""
        m = len(first) - 1
        size = np.diff(first)
        self.end = np.cumsum(size + 1) - 1  # place of the separator behind each text
        n = int(self.end[-1]) + 1
        symbols = np.empty(n, np.int64)
        symbols[self.end] = np.arange(m)  # separators differ, so no match crosses them
        inside = np.ones(n, dtype=bool)
        inside[self.end] = False
        symbols[inside] = codes + m
        rank, length, ranks = np.unique(symbols, return_inverse=True)[1], 1, {}
        half = 1 << (depth - 1).bit_length() - 1
        while True:
            ranks[length] = rank
            after = np.zeros(n, np.int64)
            after[: n - length] = rank[length:] + 1 if length < n else 0
            key = rank * (n + 2) + after
            order = np.argsort(key)
            fresh = np.concatenate([[0], key[order][1:] != key[order][:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            length *= 2
            if length > half and int(fresh.sum()) == n - 1:
                break
        self.suffixes = order
        by_half, shift = ranks[half], depth - half
        tail = np.concatenate([by_half[shift:], np.full(shift, -1)])
        same = (by_half[order][1:] == by_half[order][:-1]) & (tail[order][1:] == tail[order][:-1])
        self.klass = np.concatenate([[0], np.cumsum(~same)])
        self.low = np.flatnonzero(np.concatenate([[True], ~same]))
        self.high = np.append(self.low[1:], n)
        self.symbols = np.where(inside, symbols - m + 1, 0)  # 0: any separator
        self.bwt = WaveletMatrix(self.symbols[order - 1], n_codes + 1)
        counts = np.bincount(self.symbols, minlength=n_codes + 1)
        self.smaller = np.cumsum(counts) - counts
        self.depth, self.size, self.n = depth, size, n

    def least(self, values: np.ndarray) -> np.ndarray:
        """For each class, the least value of the texts it occurs in."""
        text = np.searchsorted(self.end, self.suffixes)
        return np.minimum.reduceat(values[text], self.low)

    def search(self):
        """Stream the indexed texts backwards, all in lockstep.

        Yields (texts, offsets, classes): where a window of ``depth`` words starts in a text, and its class.
        The interval of a text's current match holds at least the text itself, so it is never empty; when it
        grows beyond ``depth`` words it is widened to the class of its first ``depth``.
        """
        m = len(self.size)
        by_size = np.argsort(-self.size, kind="stable")
        sizes = self.size[by_size]
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        for step in range(int(sizes[0]) if m else 0):
            alive = int(np.searchsorted(-sizes, -step, "left"))  # texts longer than step
            who = by_size[:alive]
            c = self.symbols[self.end[who] - 1 - step]
            both = self.smaller[np.concatenate([c, c])] + self.bwt.rank(np.concatenate([c, c]), np.concatenate([low[:alive], high[:alive]]))
            low[:alive], high[:alive] = both[:alive], both[alive:]
            if step + 1 >= self.depth:
                k = self.klass[low[:alive]]
                low[:alive], high[:alive] = self.low[k], self.high[k]
                yield who, self.size[who] - 1 - step, k
