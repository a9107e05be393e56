"""A compressed FM-index over word ids: a Burrows-Wheeler transform in a wavelet
matrix of packed bits, searched backward for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with counts of ones before each word of 64 bits."""

    def __init__(self, bits: np.ndarray):
        size = (len(bits) + 64) // 64 * 64
        padded = np.zeros(size, bool)
        padded[: len(bits)] = bits
        self.packed = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.packed)))).astype("int32")

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        word = at >> 6
        low = self.packed[word] & ((np.uint64(1) << (at & 63).astype("uint64")) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class Wavelet:
    """Wavelet matrix of a sequence of numbers under ``most + 1``."""

    def __init__(self, seq: np.ndarray, most: int):
        self.levels, self.zeros, self.shifts = [], [], list(range(max(1, int(most).bit_length()) - 1, -1, -1))
        for s in self.shifts:
            bit = (seq >> s) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate((seq[~bit], seq[bit]))
        self.base = np.zeros(most + 1, "int64")
        self.base = self.descend(np.arange(most + 1), np.zeros(most + 1, "int64"))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for s, bits, zeros in zip(self.shifts, self.levels, self.zeros, strict=True):
            one = (symbol >> s) & 1 == 1
            ones = bits.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of each place."""
        return self.descend(symbol, at) - self.base[symbol]


class FMIndex:
    """Over a sequence of ids in which 0 separates texts. Suffixes are sorted by
    their first ``depth`` ids, which is all that patterns up to that length need."""

    def __init__(self, seq: np.ndarray, depth: int):
        rank, k = np.unique(seq, return_inverse=True)[1].astype("int64"), 1
        while k < depth:
            after = np.zeros_like(rank)
            if k < len(rank):
                after[:-k] = rank[k:] + 1
            rank, k = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1], k * 2
        order = np.argsort(rank, kind="stable")
        most = int(seq.max(initial=0))
        self.size = len(seq)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=most + 1))))[:-1]
        self.bwt = Wavelet(seq[order - 1], most)  # the first suffix is preceded by the last separator

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the patterns with one more id in front."""
        both = self.bwt.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        return self.below[symbol] + both[: len(symbol)], self.below[symbol] + both[len(symbol) :]


def repeated_windows(seq: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, depth: int) -> np.ndarray:
    """Which places of ``seq`` start a window of a text (``starts`` to ``ends``)
    that the sequence holds more than once.

    Backward search finds the longest part that ends at a place and occurs
    again: while the range has two suffixes, the part grows to the left, and
    every window inside it is repeated. Where it gets down to one, no window
    that holds the part is repeated, and the search goes on from the end of the
    next window to the left. All texts are searched side by side.
    """
    index = FMIndex(seq, depth)
    hit = np.zeros(len(seq), bool)
    live = np.flatnonzero(ends - starts >= window)
    first, end = starts[live], ends[live].copy()
    at, lo, hi = end.copy(), np.zeros(len(live), "int64"), np.full(len(live), index.size, "int64")
    while len(live):
        new_lo, new_hi = index.extend(seq[at - 1], lo, hi)
        grown = new_hi - new_lo >= 2
        at = at - 1
        lo, hi = np.where(grown, new_lo, 0), np.where(grown, new_hi, index.size)
        hit[at[grown & (end - at >= window)]] = True
        # a window that starts at ``at`` or left of it and reaches ``end`` isn't repeated,
        # and a part of ``depth`` words is as long as it gets
        stuck = ~grown
        new_end = np.where(stuck, np.minimum(end - 1, at + window), np.where(end - at >= depth, at + window - 1, end))
        moved = new_end != end
        end = new_end
        at = np.where(moved, end, at)
        lo, hi = np.where(moved, 0, lo), np.where(moved, index.size, hi)
        # done: the text's first word is in the part, or no window is left
        going = np.where(moved, end - window >= first, at > first)
        live, first, end, at, lo, hi = (x[going] for x in (live, first, end, at, lo, hi))
    return hit
