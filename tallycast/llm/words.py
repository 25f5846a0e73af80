"""Words and word shingles of whole texts as 64-bit hashes, on Arrow batches.

A word is a longest run of bytes other than blank, tab, line feed, vertical
tab, form feed and carriage return, with A-Z lowered. Equal words always have
equal hashes; different ones have different hashes up to chance (2**-64).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tallycast.llm.batches import ranges, text_bytes

SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
END_OF_TEXT = np.uint64(0x5851F42D4C957F2D)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(LOWER.astype(np.uint64) + np.uint64(1))


@dataclass
class Words:
    """The words of all texts in order: ``hashes`` and byte ``starts`` and ``sizes``; ``offsets[i]`` is the first word of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def words_of(texts: pa.LargeStringArray) -> Words:
    data, text_starts = text_bytes(texts)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = text_starts[:-1][text_starts[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = text_starts[1:][text_starts[1:] > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    if len(starts):
        powers = np.cumprod(np.full(int(sizes.max()) + 1, BASE, np.uint64))
        within = ranges(np.zeros(len(sizes), np.int64), sizes)
        values = BYTE_VALUE[data[inside]] * powers[within]
        ends = np.cumsum(sizes)
        hashes = mix(np.add.reduceat(values, ends - sizes) + sizes.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(hashes, starts, sizes, np.searchsorted(starts, text_starts))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and offsets by text; a shorter text is one run, a text without words none."""
    n = len(words.hashes)
    counts = words.counts
    short = (counts > 0) & (counts < size)
    each = np.where(short, 1, np.maximum(counts - size + 1, 0))
    starts = ranges(words.offsets[:-1], each)
    length = np.repeat(np.minimum(counts, size), each)
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    out = length.astype(np.uint64)
    for k in range(size):
        out = np.where(k < length, mix(out * BASE + padded[np.minimum(starts + k, n)]), out)
    return out, np.concatenate([[0], np.cumsum(each)])
