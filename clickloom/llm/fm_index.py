"""An FM-index over word ids: a wavelet matrix of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with the number of ones before every 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 8, np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        ones = np.bitwise_count(self.words)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, count: int):
        self.levels: list[tuple[int, int, BitVector]] = []
        current = symbols
        for bit in reversed(range(max(1, (count - 1).bit_length()))):
            bits = ((current >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, int(len(bits) - bits.sum()), BitVector(bits)))
            current = np.concatenate([current[bits == 0], current[bits == 1]])
        every = np.arange(count)
        self.base = self._down(every, np.zeros(count, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for bit, zeros, vector in self.levels:
            ones = vector.rank(places)
            places = np.where((symbols >> bit) & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, places) - self.base[symbols]


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols in texts joined by the symbol 0.

    Suffixes are sorted by their first ``depth`` symbols or a few more, which is all that such patterns can tell apart.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        count = int(symbols.max()) + 1
        rank, step = symbols.astype(np.int64), 1
        while step < depth:
            # As many ranks in a row as one integer takes, at least two.
            base, codes, many = int(rank.max()) + 1, rank, 1
            while many * step < depth and (many < 2 or base ** (many + 1) < 1 << 63):
                following = np.append(rank[many * step :], np.zeros(min(many * step, len(rank)), np.int64))
                codes, many = codes * base + following, many + 1
            rank = np.unique(codes, return_inverse=True)[1]
            step *= many
        self.order = np.argsort(rank, kind="stable")
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=count))])
        self.matrix = WaveletMatrix(symbols[self.order - 1], count)

    def search(self, patterns: np.ndarray, settle: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ranges (low, high) of sorted suffixes that start with each row of ``patterns``.

        Patterns that end alike are one state of the search until they part. With ``settle``, for patterns that the
        texts hold, an end that occurs once ends its search: its range stands for the one place of the pattern, by the
        suffix that starts there or later in it.
        """
        count = len(self.before) - 1
        states, at = np.unique(patterns[:, -1], return_inverse=True)
        low, high = self.before[states], self.before[states + 1]
        for k in range(patterns.shape[1] - 2, -1, -1):
            symbol = patterns[:, k]
            if settle:
                # Symbol 0, which is in no pattern, stands for no step.
                symbol = np.where((high - low == 1)[at], 0, symbol)
            codes, at = np.unique(at * count + symbol, return_inverse=True)
            symbol, old = codes % count, codes // count
            low, high = low[old], high[old]
            moved = np.flatnonzero(symbol) if settle else slice(None)
            symbol = symbol[moved]
            low[moved] = self.before[symbol] + self.matrix.rank(symbol, low[moved])
            high[moved] = self.before[symbol] + self.matrix.rank(symbol, high[moved])
        return low[at], high[at]
