"""FM-index over the words of a shard of texts.

A shard's pieces of text stand behind each other as word numbers (1 and up),
each behind a separator (0). The suffixes are sorted by doubling, the symbols
before them (the Burrows-Wheeler transform) kept as a wavelet matrix: one bit
vector for each binary digit, whose ranks come from the ones before each
64-bit word and a population count. Backward search narrows the interval of
suffixes that start with a phrase, last word first, for all phrases at once.
Positions of an interval are found by stepping back to the next sampled
suffix; the first word of every piece is sampled, so no step crosses one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 16          # every 16th position is sampled
LOCATE = 1 << 18     # occurrences located at a time
PACK = 3             # symbols compared by the first sort


def sort_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Suffix array; separators (0) count as distinct and rise with their position.

    So equal pieces differ at their ends, and a round of doubling sorts only
    suffixes that still tie.
    """
    n = len(symbols)
    apart = symbols == 0
    rank = symbols.astype(np.int64) + int(apart.sum())
    rank[apart] = np.arange(int(apart.sum()))
    base = int(rank.max(initial=0)) + 1
    wide = np.concatenate([rank, np.zeros(PACK, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(PACK):
        key = key * base + wide[k:n + k]
    order = np.argsort(key, kind="stable")
    key = key[order]
    slots, step = np.arange(n), PACK
    while len(slots):
        # groups of equal keys; a group's rank is the slot of its first suffix
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        rank[order[slots]] = slots[begin][group]
        open_ = np.diff(np.append(begin, len(key)))[group] > 1
        slots = slots[open_]
        at = order[slots]
        key = (rank[at] << 32) | rank[at + step] if len(slots) else rank[:0]
        sorted_ = np.argsort(key, kind="stable")
        order[slots], key = at[sorted_], key[sorted_]
        step *= 2
    return order


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, with at least one word to spare behind the last bit."""
    out = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
    packed = np.packbits(bits, bitorder="little")
    out[:len(packed)] = packed
    return out.view("<u8")


class Bits:
    """A bit vector with constant-time ranks."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def bit(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


@dataclass
class Parts:
    """What is stored of an index: numpy arrays of fixed types."""

    counts: np.ndarray   # of each symbol, uint32
    bits: np.ndarray     # wavelet matrix, levels x words, uint64
    marks: np.ndarray    # sampled rows, uint64 words
    samples: np.ndarray  # positions of the sampled rows, uint32


def build(symbols: np.ndarray) -> Parts:
    """Index of symbols that begin and end with a separator."""
    n = len(symbols)
    order = sort_suffixes(symbols)
    column = symbols[order - 1]  # position 0 is a separator, and so is the symbol before it, the last one
    counts = np.bincount(symbols).astype(np.uint32)
    levels = max(1, (len(counts) - 1).bit_length())
    bits = np.zeros((levels, n // 64 + 1), np.uint64)
    for level in range(levels):
        one = (column >> (levels - 1 - level)) & 1 == 1
        bits[level] = pack_bits(one)
        column = np.concatenate([column[~one], column[one]])
    begins = np.zeros(n, bool)
    begins[1:] = symbols[:-1] == 0
    marked = (order % SAMPLE == 0) | begins[order]
    return Parts(counts, bits, pack_bits(marked), order[marked].astype(np.uint32))


class Index:
    def __init__(self, parts: Parts):
        self.size = int(parts.counts.sum())
        self.levels = [Bits(w) for w in parts.bits]
        self.zeros = [self.size - int(level.rank(np.array([self.size]))[0]) for level in self.levels]
        self.marks, self.samples = Bits(parts.marks), parts.samples.astype(np.int64)
        starts = np.cumsum(parts.counts, dtype=np.int64) - parts.counts
        every = np.arange(len(parts.counts), dtype=np.int64)
        # from a place below the last level to the row of the suffix that is one symbol longer
        self.shift = starts - self._follow(every, np.zeros(len(every), np.int64))

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of ``at`` below the last level, going as the digits of ``symbol`` say."""
        top = len(self.levels) - 1
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = level.rank(at)
            at = np.where((symbol >> (top - i)) & 1 == 1, zeros + ones, at - ones)
        return at

    def _back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that begins one symbol earlier."""
        symbol, at = np.zeros(len(row), np.int64), row
        for level, zeros in zip(self.levels, self.zeros):
            one, ones = level.bit(at), level.rank(at)
            symbol = symbol * 2 + one
            at = np.where(one == 1, zeros + ones, at - ones)
        return self.shift[symbol] + at

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lo, hi) rows of each phrase (a row of symbols, shorter ones with -1 in front); none where lo = hi."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            symbol = column[live].astype(np.int64)
            live, symbol = live[symbol >= 0], symbol[symbol >= 0]
            if not len(live):
                break
            ends = self._follow(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.shift[symbol] + ends[:len(live)]
            hi[live] = self.shift[symbol] + ends[len(live):]
            live = live[hi[live] > lo[live]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in ``rows``."""
        out = np.zeros(len(rows), np.int64)
        for k in range(0, len(rows), LOCATE):
            todo, at, steps = np.arange(k, min(k + LOCATE, len(rows))), rows[k:k + LOCATE], 0
            while len(todo):
                known = self.marks.bit(at) == 1
                out[todo[known]] = self.samples[self.marks.rank(at[known])] + steps
                todo, at, steps = todo[~known], self._back(at[~known]), steps + 1
        return out
