"""Vectorised words: boundaries and 64-bit hashes of all words of a run of texts in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = U(0x5851F42D4C957F2D)
BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_PLAIN = np.zeros(256, bool)
NOT_PLAIN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        factors = np.full(max(n, 1024), BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers[:n]


@dataclass
class Words:
    """``doc[i]`` is the row of word i; rows' words are ``bounds[row]:bounds[row + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; different words collide by chance only."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lengths = self.end - self.start
        first = np.cumsum(lengths) - lengths
        within = np.arange(lengths.sum()) - np.repeat(first, lengths)
        at = within + np.repeat(self.start, lengths)
        terms = BYTE_VALUES[self.data[at]] * powers(int(lengths.max()))[within]
        return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))

    def code_points(self) -> np.ndarray:
        """Code points of each word: bytes that do not continue one."""
        heads = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return heads[self.end] - heads[self.start]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and where each row starts (one more at the end)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0]) if len(offsets) else 0
    raw = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words_of(column: pa.Array, breaks: np.ndarray = SPACE, lower: bool = False) -> Words:
    data, offsets = buffer_of(column)
    if lower:
        data = LOWERED[data]
    n = len(data)
    inside = ~breaks[data]
    heads = np.zeros(n + 1, bool)
    heads[offsets] = True
    starts = inside.copy()
    starts[1:] &= breaks[data[:-1]] | heads[1:n]
    ends = inside.copy()
    ends[:-1] &= breaks[data[1:]] | heads[1:n]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    bounds = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(data, offsets, start, end, doc, bounds)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every ``n`` consecutive words (windows across rows included)."""
    total = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for i in range(n):
        total = total * BASE + hashes[i : len(hashes) - n + 1 + i]
    return mix(total)
