"""Words of many texts at once, as 64-bit hashes, without a Python object for each word.

A word is a longest run of bytes other than 20 and 09 to 0D (hexadecimal). Those never
occur inside a UTF-8 character, so words of bytes are words of characters. A word's hash is the sum of its blocks of eight
bytes, each mixed with its place by a non-linear function, so no pattern of letters makes hashes equal; two different
words or n-grams share one by chance, with probability 2^-64. Where that is not enough, ``same`` compares words byte by byte.
"""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (the finaliser of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: Masks for the first 0 to 8 bytes of a block.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
BLOCK = 8


class Words:
    """``start``, ``end``: places in the bytes; ``doc``: the text; ``hash``: of the word. ``apart``: places
    where a word begins anew, inside texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, fold: bool = False, apart: np.ndarray | None = None):
        self.n_docs = len(bounds) - 1
        if fold:
            data = _FOLD[data]
        inside = ~WHITE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = bounds[(bounds > 0) & (bounds < len(data))]
        if apart is not None:
            cuts = np.concatenate([cuts, apart])
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(bounds, self.start, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)
        self.length = self.end - self.start
        self.n_blocks = -(-self.length // BLOCK)
        self.first_block = np.cumsum(self.n_blocks) - self.n_blocks
        self.blocks = self._blocks(data)
        self.hash = self._hashes()

    def _blocks(self, data: np.ndarray) -> np.ndarray:
        """Eight bytes of a word in each, the last filled up with zeros."""
        padded = np.concatenate([data, np.zeros(BLOCK, np.uint8)])
        every = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        self._place = np.arange(int(self.n_blocks.sum())) - np.repeat(self.first_block, self.n_blocks)
        at = np.repeat(self.start, self.n_blocks) + self._place * BLOCK
        left = np.repeat(self.end, self.n_blocks) - at
        return every[at] & _FIRST[np.minimum(left, BLOCK)]

    def _hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        mixed = mix(self.blocks ^ mix(self._place.astype(np.uint64)))
        total = np.add.reduceat(mixed, self.first_block)
        return mix(total + self.length.astype(np.uint64) * _STEP)

    def same(self, word: np.ndarray, like: np.ndarray) -> np.ndarray:
        """Whether each of some words is byte for byte the word ``like`` of it."""
        return same_blocks(
            self.blocks, self.first_block[word], self.length[word],
            self.blocks, self.first_block[like], self.length[like],
        )

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows within a text, and the place of their first word."""
        size = len(self.hash) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:size] == self.doc[n - 1 :])
        total = np.zeros(len(at), np.uint64)
        factor = np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(n):
                factor = factor * _MIX[1] + np.uint64(2 * k)
                total += self.hash[at + k] * factor
        return mix(total), at


def same_blocks(blocks, at, length, others, other_at, other_length) -> np.ndarray:
    """Whether the words that start at these blocks and have these lengths are equal, pair by pair."""
    equal = length == other_length
    pair = np.flatnonzero(equal)
    n = -(-length[pair] // BLOCK)
    owner = np.repeat(pair, n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    equal[owner[blocks[at[owner] + place] != others[other_at[owner] + place]]] = False
    return equal


def count_in(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flagged bytes each text has."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
