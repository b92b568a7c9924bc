"""An FM-index over a sequence of symbols: wavelet ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class Bits:
    """A bit row with ranks: packed words and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; after each round only suffixes that still tie are sorted again."""
    size = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(size + 1, np.int64)
    rank[size] = -1
    starts = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    rank[order] = starts
    width = 1
    while True:
        alone = first & np.concatenate([first[1:], [True]])
        tied = np.flatnonzero(~alone)
        if not len(tied):
            return order
        suffix = order[tied]
        ahead = rank[np.minimum(suffix + width, size)]
        group = rank[suffix]
        again = np.lexsort((ahead, group))
        suffix, ahead, group = suffix[again], ahead[again], group[again]
        order[tied] = suffix
        first[tied] = np.concatenate([[True], (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])])
        starts = np.maximum.accumulate(np.where(first, np.arange(size), 0))
        rank[suffix] = starts[tied]
        width *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, top: int):
        """Index ``symbols`` (1 to ``top``; 0 separates)."""
        text = np.append(symbols.astype(np.int64), -1) + 1  # 0 ends the text, 1 separates
        order = suffix_order(text)
        self.size, self.levels = len(text), max(1, int(top + 1).bit_length())
        last = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 2))])
        self.rows, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = last >> level & 1
            self.rows.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            last = np.concatenate([last[bits == 0], last[bits == 1]])
        every = np.arange(top + 2)
        self.begins = self._down(every, np.zeros(len(every), np.int64))
        sampled = order % SAMPLE == 0
        self.marks, self.samples = Bits(sampled), order[sampled]

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.rows, self.zeros)):
            ones = bits.ones(at)
            at = np.where(symbol >> (self.levels - 1 - k) & 1, zeros + ones, at - ones)
        return at

    def occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the last column."""
        return self._down(symbol, at) - self.begins[symbol]

    def step_back(self, at: np.ndarray) -> np.ndarray:
        """Row of the suffix that begins one symbol earlier."""
        symbol, down = np.zeros(len(at), np.int64), at
        for bits, zeros in zip(self.rows, self.zeros):
            one, ones = bits.get(down), bits.ones(down)
            symbol = symbol << 1 | one
            down = np.where(one, zeros + ones, down - ones)
        return self.before[symbol] + down - self.begins[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns (right-aligned rows of symbols, all patterns at a time)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        for back in range(1, width + 1):
            on = np.flatnonzero((lengths >= back) & (low < high))
            if not len(on):
                break
            symbol = patterns[on, width - back].astype(np.int64) + 1
            low[on] = self.before[symbol] + self.occurrences(symbol, low[on])
            high[on] = self.before[symbol] + self.occurrences(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled one."""
        places, walked = np.full(len(rows), -1, np.int64), 0
        waiting, at = np.arange(len(rows)), rows
        while len(waiting):
            known = self.marks.get(at)
            places[waiting[known]] = self.samples[self.marks.ones(at[known])] + walked
            waiting, at, walked = waiting[~known], at[~known], walked + 1
            if len(waiting):
                at = self.step_back(at)
        return places
