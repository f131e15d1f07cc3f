"""An FM-index over sequences of word numbers, built and searched in whole-array steps.

The text is an array of symbols. Symbol 0 ends a run: no pattern holds it, and each of its
occurrences counts as a symbol of its own, ordered by place. So two suffixes differ at the first 0 at
the latest, copies of long texts cost no more than others, and no search runs across a 0.
"""

from __future__ import annotations

import numpy as np

_BITS = 21
#: Symbols in one index: a rank takes 21 bits, and two ranks and a place are sorted as one word.
MOST = (1 << _BITS) - 1
_PLACE = (1 << _BITS) - 1


class BitRanks:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletTree:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol, highest bit first."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, BitRanks, int]] = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1 == 1
            self.levels.append((bit, BitRanks(ones), len(sequence) - int(np.count_nonzero(ones))))
            sequence = np.concatenate((sequence[~ones], sequence[ones]))
        self.first = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ranks, zeros in self.levels:
            ones = ranks.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place beside it."""
        return self._down(symbol, at) - self.first[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), np.int64)
        for bit, ranks, zeros in self.levels:
            ones, one = ranks.ones(at), ranks.get(at)
            symbol |= one.astype(np.int64) << bit
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """The places of all suffixes in order, by prefix doubling over those still tied."""
    n, bits = len(text), max(1, int(symbols - 1).bit_length())
    depth = max(1, (63 - _BITS) // bits)
    key, open_ = text.astype(np.int64), text > 0
    for step in range(1, depth):
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = text[step:]
        open_ &= ahead > 0
        key = key << bits | np.where(open_, ahead, 0)
    packed = np.sort(key << _BITS | np.arange(n))
    order = packed & _PLACE
    key = packed >> _BITS
    # Suffixes that end within the first symbols stand in the order of their ends, which is that of their places.
    new = ~open_[order]
    new[0] = True
    new[1:] |= key[1:] != key[:-1]
    row = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, row, 0))
    last = np.append(new[1:], True)
    rows = row[~(new & last)]
    while len(rows):
        place = order[rows]
        packed = np.sort(rank[place] << 2 * _BITS | rank[place + depth] << _BITS | place)
        place = order[rows] = packed & _PLACE
        key = packed >> _BITS
        new = np.append(True, key[1:] != key[:-1])
        rank[place] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        last = np.append(new[1:], True)
        rows = rows[~(new & last)]
        depth *= 2
    return order


class FMIndex:
    """``symbols``: how many there are, 0 included. ``sample``: every so many places one is kept."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        if len(text) > MOST:
            raise ValueError(f"an index holds at most {MOST} symbols")
        if not len(text) or text[-1]:
            text = np.append(text, 0)
        text = text.astype(np.int32)
        order = suffix_order(text, symbols)
        before = np.where(order > 0, text[order - 1], 0)
        self.tree = WaveletTree(before, symbols)
        self.less = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.less[1:])
        kept = (before == 0) | (order % sample == 0)
        self.kept, self.places = BitRanks(kept), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern.

        ``patterns``: one a row, filled up with zeros at the end; read from its last symbol back.
        """
        low, high = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        live = np.flatnonzero(lengths > 0)
        symbol = patterns[live, lengths[live] - 1]
        low[live], high[live] = self.less[symbol], self.less[symbol + 1]
        step = 1
        while True:
            live = live[low[live] < high[live]]
            going = live[lengths[live] > step]
            if not len(going):
                return low, high
            symbol = patterns[going, lengths[going] - 1 - step]
            low[going] = self.less[symbol] + self.tree.rank(symbol, low[going])
            high[going] = self.less[symbol] + self.tree.rank(symbol, high[going])
            step += 1

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of the suffixes in these rows: back to the nearest kept place, counting steps."""
        out, steps = np.empty(len(rows), np.int64), 0
        waiting, rows = np.arange(len(rows)), rows.copy()
        while len(waiting):
            here = self.kept.get(rows)
            out[waiting[here]] = self.places[self.kept.ones(rows[here])] + steps
            waiting, rows = waiting[~here], rows[~here]
            symbol, rank = self.tree.symbol_and_rank(rows)
            rows = self.less[symbol] + rank
            steps += 1
        return out
