"""Hashes of words and word windows in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)
LONG_WORD = 64
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word of a UTF-8 text, eight bytes at a time over all words.

    Words are split at the six white-space characters; those of more than
    LONG_WORD bytes are hashed one by one.
    """
    padded = text + b" " * 8
    inside = IN_WORD[np.frombuffer(padded, dtype=np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    start, size = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray(len(text) + 1, dtype="<u8", buffer=padded, strides=(1,))
    out = mix(size.astype(np.uint64))
    live = np.arange(len(start))
    for done in range(0, LONG_WORD, 8):
        live = live[size[live] > done]
        if not len(live):
            break
        part = eights[start[live] + done] & FIRST_BYTES[np.minimum(size[live] - done, 8)]
        out[live] = mix(out[live] ^ part)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(text[start[i] : start[i] + size[i]])
    return out


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random."""
    z = values + STEP
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for shift in range(1, width):
        total = total * BASE + hashes[shift : shift + n]
    return mix(total)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    both = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


class Prefixes:
    """Hashes of any run of words, from one pass over the words.

    Sums of hash times power; a run is brought to its own start by the inverse power.
    """

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up, self.down = _powers(1 << max(12, int(n + 1).bit_length()))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        run = (self.sums[start + size] - self.sums[start]) * self.down[start]
        return mix(run ^ size.astype(np.uint64))
