"""A compressed full-text index over word ids: a wavelet matrix of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A packed bit vector with constant-time counts of ones."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8))).view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = int(len(bits) - self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Occurrence counts of any symbol in any prefix, a bit vector per binary digit."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.digits = max(1, int(alphabet - 1).bit_length())
        self.levels: list[RankBits] = []
        for digit in range(self.digits - 1, -1, -1):
            bit = ((symbols >> digit) & 1).astype(bool)
            self.levels.append(RankBits(bit))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))
        self.first = self._down(np.arange(alphabet), np.zeros(alphabet, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for digit, level in zip(range(self.digits - 1, -1, -1), self.levels):
            ones = level.ones(at)
            at = np.where((symbol >> digit) & 1, level.zeros + ones, at - ones)
        return at

    def count(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``at`` symbols."""
        return self._down(symbol, at) - self.first[symbol]


def _ranked(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the different ones, from 0."""
    order = np.argsort(values)
    ordered = values[order]
    rank = np.empty(len(values), dtype=np.int32 if len(values) < 1 << 31 else np.int64)
    rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]), dtype=rank.dtype)
    return rank


class FMIndex:
    """Index of many word sequences for windows of ``window`` words.

    ``ids`` are the words of all sequences as numbers from 1, each sequence closed by a 0. Suffixes
    are sorted by at least window + 1 words, which is as far as searches look. ``owner`` gives a
    number per place; ``least`` answers the smallest owner of a window's occurrences.
    """

    def __init__(self, ids: np.ndarray, owner: np.ndarray, window: int):
        n, self.window = len(ids), window
        ranks, depth = [_ranked(ids)], 1
        while depth <= window:
            pairs = ranks[-1].astype(np.int64) * (n + 2)
            pairs[:max(n - depth, 0)] += ranks[-1][depth:]
            pairs[:max(n - depth, 0)] += 1
            ranks.append(_ranked(pairs))
            depth *= 2
        del pairs
        order = np.argsort(ranks[-1], kind="stable")
        heads, which = self._groups(ranks, order, window)
        self.least = np.minimum.reduceat(owner[order], heads)[which]
        heads, which = self._groups(ranks, order, window - 1)
        del ranks
        self.low, self.high = heads[which], np.append(heads[1:], n)[which]
        del which
        alphabet = int(ids.max()) + 2
        self.unknown = alphabet - 1  # a word that the index does not hold
        self.transform = WaveletMatrix(ids[order - 1], alphabet)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=alphabet))))

    @staticmethod
    def _groups(ranks: list[np.ndarray], order: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First places of the groups of suffixes that agree in ``depth`` words, and the group of each suffix."""
        n = len(order)
        differ, at = np.zeros(n, dtype=bool), 0
        for k in range(len(ranks) - 1, -1, -1):
            if depth & (1 << k):
                inside = np.minimum(order + at, n - 1)
                rank = np.where(order + at < n, ranks[k][inside], -1)
                differ[1:] |= rank[1:] != rank[:-1]
                at += 1 << k
        differ[0] = True
        heads = np.flatnonzero(differ)
        which = np.cumsum(differ, dtype=ranks[0].dtype)
        which -= 1
        return heads.astype(which.dtype), which

    def extend(self, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the range of the match with ``word`` before it."""
        return (self.starts[word] + self.transform.count(word, low), self.starts[word] + self.transform.count(word, high))

    def matches(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each streamed sequence ids[begin:end], by window start, the smallest owner of the
        window's occurrences in the index; the largest number there is where it has none. Returned flat,
        with the cuts between the sequences.

        Matching statistics from right to left, cut at the window: a match of full length is
        recorded, shortened by its last word (its range widens to the group that agrees in the
        others) and extended by the word before. Where a match ends early no window ends at its
        last word, and the search goes on one word to the left of that.
        """
        size, most = len(self.low), np.iinfo(np.int64).max
        sizes = np.maximum(end - begin - self.window + 1, 0)
        cuts = np.append(0, np.cumsum(sizes))
        out = np.full(cuts[-1], most)
        low, high = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), size, dtype=np.int64)
        length = np.zeros(len(begin), dtype=np.int64)
        active, at = np.arange(len(begin)), end - 1
        while True:
            last = at[active] + length[active]
            active = active[(at[active] >= begin[active]) & (last - begin[active] + 1 >= self.window)]
            if not len(active):
                return out, cuts
            lo, hi = self.extend(low[active], high[active], ids[at[active]])
            length[active] += 1
            full = length[active] == self.window
            full &= lo < hi
            done = active[full]
            out[cuts[done] + at[done] - begin[done]] = self.least[lo[full]]
            lo[full], hi[full] = self.low[lo[full]], self.high[lo[full]]
            length[active[full]] -= 1
            failed = lo >= hi
            at[active] -= 1
            over = active[failed]
            at[over] += length[over] - 1
            length[over] = 0
            lo[failed], hi[failed] = 0, size
            low[active], high[active] = lo, hi
