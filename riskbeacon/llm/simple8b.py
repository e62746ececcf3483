"""Simple-8b: runs of non-negative integers in 64-bit words.

The top four bits of a word select how many values it holds and how many
bits each takes; selector 15 is an escape for a value of more than 60 bits:
its payload is the value's place in a separate list. Encoding walks many
segments of the input in step; decoding treats all words of a selector at
once.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format, by selector: values in a word, bits of a value.
COUNTS = [240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1]
BITS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60]
ESCAPE = 15
SEGMENT = 256        # ids of one walk; words don't cross it; many short walks make long vectors
INDEX_EVERY = 1024   # words between two entries of the offset index

_NEAR = 12           # most values seen at once; selectors above need small ids
_N = np.array(COUNTS, dtype=np.int64)


def bit_width(ids: np.ndarray) -> np.ndarray:
    """Bits that each value needs (0 for 0), as int8."""
    ids = ids.astype(np.uint64, copy=False)
    high = ids >> np.uint64(32)
    out = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.int8)
    if high.any():
        big = high > 0
        out[big] = 32 + np.frexp(high[big].astype(np.float64))[1].astype(np.int8)
    return out


def _choose(width: np.ndarray, pos: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The selector with most values for the word that starts at each pos."""
    left = end - pos
    near = np.maximum.accumulate(width[pos[:, None] + np.arange(_NEAR)], axis=1)
    sel = np.full(len(pos), ESCAPE, np.int64)
    for s in range(14, 4, -1):  # 60 bits down to 5 bits: at most 12 values
        n = COUNTS[s]
        sel[(near[:, n - 1] <= BITS[s]) & (left >= n)] = s
    few = np.flatnonzero((near[:, _NEAR - 1] <= 4) & (left >= COUNTS[4]))
    if len(few):
        far = np.maximum.accumulate(width[pos[few, None] + np.arange(COUNTS[0])], axis=1)
        for s in range(4, -1, -1):
            n = COUNTS[s]
            sel[few[(far[:, n - 1] <= BITS[s]) & (left[few] >= n)]] = s
    return sel


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes), both uint64; every value appears in exactly one word."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    width = np.concatenate((bit_width(ids), np.zeros(COUNTS[0], np.int8)))
    pos = np.arange(0, n, SEGMENT, dtype=np.int64)
    end = np.minimum(pos + SEGMENT, n)
    starts, sels = [], []
    while len(pos):
        s = _choose(width, pos, end)
        starts.append(pos)
        sels.append(s)
        pos = pos + _N[s]
        go = pos < end
        pos, end = pos[go], end[go]
    start, sel = np.concatenate(starts), np.concatenate(sels)
    order = np.argsort(start, kind="stable")
    start, sel = start[order], sel[order]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        at = np.flatnonzero(sel == s)
        if s == ESCAPE:
            words[at] |= np.arange(len(at), dtype=np.uint64)
        elif BITS[s]:
            shift = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            words[at] |= np.bitwise_or.reduce(ids[start[at, None] + np.arange(COUNTS[s])] << shift, axis=1)
    return words, ids[start[sel == ESCAPE]]


def word_offsets(words: np.ndarray) -> np.ndarray:
    """Values before each word, and the total at the end."""
    return np.concatenate(([0], np.cumsum(_N[(words >> np.uint64(60)).astype(np.int64)])))


def index(words: np.ndarray) -> np.ndarray:
    """Values before every ``INDEX_EVERY``-th word."""
    return word_offsets(words)[:-1][::INDEX_EVERY]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All values of the words, as uint64."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    off = word_offsets(words)
    out = np.zeros(int(off[-1]), np.uint64)
    for s in np.unique(sel):
        at = np.flatnonzero(sel == s)
        if s == ESCAPE:
            out[off[at]] = escapes[(words[at] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif BITS[s]:
            shift = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            mask = np.uint64((1 << BITS[s]) - 1)
            out[off[at, None] + np.arange(COUNTS[s])] = (words[at, None] >> shift) & mask
    return out


def decode_range(words: np.ndarray, escapes: np.ndarray, idx: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Values lo..hi-1: only the words around them are decoded, found by the index."""
    if hi <= lo or not len(words):
        return np.zeros(0, np.uint64)
    first = int(np.searchsorted(idx, lo, side="right")) - 1
    last = int(np.searchsorted(idx, hi, side="left"))
    got = decode(words[first * INDEX_EVERY:last * INDEX_EVERY], escapes)
    return got[lo - int(idx[first]):hi - int(idx[first])]
