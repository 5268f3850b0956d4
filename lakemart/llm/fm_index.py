"""A compressed FM-index over integer sequences: wavelet matrix, backward search.

The index holds many short sequences, each closed by symbol 0, which no pattern
has.  Suffixes are sorted by their first 64 symbols, so patterns must be shorter.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class WaveletMatrix:
    """Rank of any symbol in a sequence: one packed bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        now = symbols.astype(np.int32)
        n = len(now)
        padded = np.zeros((n // 32 + 1) * 32, dtype=np.uint8)
        for level in range(self.levels):
            bit = (now >> (self.levels - 1 - level)) & 1
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint32)
            ones = np.cumsum(np.bitwise_count(packed), dtype=np.int32)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], ones[:-1]]).astype(np.int32))
            self.zeros.append(np.int32(n - ones[-1]))
            one = bit == 1
            now = np.concatenate([now[~one], now[one]])
        everything = np.arange(sigma, dtype=np.int32)
        self.start = self._descend(everything, np.zeros(sigma, dtype=np.int32))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            word = at >> 5
            below = (np.uint32(1) << (at & 31).astype(np.uint32)) - np.uint32(1)
            ones = self.before[level].take(word)
            ones += np.bitwise_count(self.words[level].take(word) & below)
            at = np.where((symbol >> (self.levels - 1 - level)) & 1, ones + self.zeros[level], at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of a place."""
        return self._descend(symbol, at) - self.start[symbol]


def sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Suffixes by their first DEPTH symbols, by doubling from the first three.

    A suffix is ranked by the first place of its ties, so that each round sorts
    only what is still tied.
    """
    n = len(text)
    key = text.astype(np.int64)
    base = int(key.max(initial=0)) + 1
    reach = 1
    if base < 1 << 20:  # three symbols fit into one key
        padded = np.concatenate([key, np.zeros(2, np.int64)])
        key = (padded[:n] * base + padded[1 : n + 1]) * base + padded[2 : n + 2]
        reach = 3
    order = np.argsort(key)
    rank = np.full(n + DEPTH, -1, dtype=np.int64)  # nothing comes first
    at, rank[order] = _ties(key[order], np.arange(n))
    while reach < DEPTH and len(at):
        tied = order[at]
        key = rank[tied] * (n + 1) + rank[tied + reach] + 1
        again = np.argsort(key)
        tied = tied[again]
        order[at] = tied
        at, rank[tied] = _ties(key[again], at)
        reach *= 2
    return order


def _ties(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key another one has, and for all places the first of their key."""
    new = np.ones(len(key) + 1, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:-1])
    first = np.maximum.accumulate(np.where(new[:-1], at, 0))
    return at[~(new[:-1] & new[1:])], first


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal symbols of neighbouring suffixes, at most DEPTH; -1 at both ends.

    Place i compares suffixes i - 1 and i.  A closing 0 ends a prefix.
    """
    n = len(order)
    padded = np.concatenate([text, np.zeros(DEPTH, dtype=text.dtype)])
    lcp = np.zeros(n + 1, dtype=np.int32)
    lcp[0] = lcp[n] = -1
    rows = np.arange(1, n, dtype=np.int32)
    left, right = order[:-1], order[1:]
    for depth in range(1, DEPTH + 1):
        a = padded.take(left)
        same = np.flatnonzero((a == padded.take(right)) & (a != 0))
        if not len(same):
            break
        rows, left, right = rows[same], left[same] + 1, right[same] + 1
        lcp[rows] = depth
    return lcp


def smaller_before(values: np.ndarray) -> np.ndarray:
    """The nearest earlier place with a smaller value (place 0 has the least)."""
    at = np.arange(-1, len(values) - 1, dtype=np.int32)
    at[0] = 0
    rows = np.flatnonzero(values[:-1] >= values[1:]) + 1
    while len(rows):
        jump = at.take(at.take(rows))
        at[rows] = jump
        rows = rows[(values.take(jump) >= values.take(rows)) & (jump > 0)]
    return at


class FmIndex:
    """Sequences of numbers from 1, searched backwards."""

    def __init__(self, sequences: np.ndarray, sizes: np.ndarray):
        """``sequences`` one behind the other, ``sizes`` their lengths."""
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(int(sizes.sum()) + len(sizes), dtype=np.int32)
        inside = np.ones(len(text), dtype=bool)
        inside[ends] = False
        text[inside] = sequences
        self.n = len(text)
        sigma = int(text.max()) + 1 if self.n else 1
        order = sorted_suffixes(text)
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))]).astype(np.int32)
        self.wavelet = WaveletMatrix(text[order - 1], sigma)
        self.lcp = common_prefixes(text, order)
        self.up = smaller_before(self.lcp)
        self.down = self.n - smaller_before(self.lcp[::-1])[::-1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffixes that have one more symbol in front."""
        first = self.counts[symbol]
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return first + both[: len(low)], first + both[len(low) :]

    def shorten(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider range: its length and borders, once symbols are dropped at the end."""
        size = np.maximum(self.lcp[low], self.lcp[high])
        low, high = low.copy(), high.copy()
        for at, jump in ((low, self.up), (high, self.down)):
            rows = np.flatnonzero(self.lcp[at] >= size)
            while len(rows):
                at[rows] = jump[at[rows]]
                rows = rows[self.lcp[at[rows]] >= size[rows]]
        return np.maximum(size, 0), low, high


def matching_statistics(index: FmIndex, sequences: np.ndarray, sizes: np.ndarray, copies: np.ndarray, least: int = 0) -> np.ndarray:
    """For each place the longest run from there that is found at least twice.

    The sequences are streamed against an index that holds them; ``copies`` says
    how many occurrences each sequence stands for.  A sequence is left, its other
    places at 0, where no run in front can reach ``least`` any more: a run grows
    by at most one symbol a place.
    """
    begin = np.cumsum(sizes) - sizes
    sequences = sequences.astype(np.int32)
    found = np.zeros(len(sequences), dtype=np.int32)
    low = np.zeros(len(sizes), dtype=np.int32)
    high = np.full(len(sizes), index.n, dtype=np.int32)
    length = np.zeros(len(sizes), dtype=np.int32)
    live = np.arange(len(sizes))
    for step in range(1, int(sizes.max(initial=0)) + 1):
        live = live[sizes[live] >= step]
        place = begin + sizes - step
        waiting = live
        while len(waiting):
            new_low, new_high = index.extend(sequences[place[waiting]], low[waiting], high[waiting])
            twice = (new_high - new_low >= 2) | ((new_high > new_low) & (copies[waiting] >= 2))
            good = waiting[twice]
            low[good], high[good] = new_low[twice], new_high[twice]
            length[good] += 1
            waiting = waiting[~twice]
            waiting = waiting[length[waiting] > 0]  # an empty match cannot shrink
            if len(waiting):
                length[waiting], low[waiting], high[waiting] = index.shorten(low[waiting], high[waiting])
        found[place[live]] = length[live]
        live = live[sizes[live] - step + length[live] >= least]
    return found
