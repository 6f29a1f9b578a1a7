"""Whole texts as flat arrays: blocks of Arrow strings, ASCII-rule words, hashes.

The helpers run inside Spark tasks on one block of rows at a time. A block holds about
``BLOCK_BYTES`` of text, so memory does not follow the batch size; a longer text is a
block of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed only."""
    start = np.uint64((seed * 0x632BE59BD9B4E019 + 1) % (1 << 64))
    with np.errstate(over="ignore"):
        steps = start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(steps) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and n + 1 row limits; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    limits = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[limits[0] : limits[-1]]
    return raw, limits - limits[0]


def blocks(
    column: pa.Array, size: int = BLOCK_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, row limits) of consecutive rows with about `size` bytes together."""
    raw, limits = text_bytes(column)
    first = 0
    while first < len(limits) - 1:
        last = int(np.searchsorted(limits, limits[first] + size, side="right")) - 1
        last = max(last, first + 1)
        last = min(last, first + 4096, len(limits) - 1)
        part = limits[first : last + 1]
        yield slice(first, last), raw[part[0] : part[-1]], part - part[0]
        first = last


def word_limits(
    inside: np.ndarray, limits: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes, cut at row limits, and words before each row."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(limits), np.int64)
    cuts = limits[:-1][limits[:-1] < len(inside)]
    before = np.empty(len(inside), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.empty(len(inside), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, limits)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word (multilinear over its bytes, then mixed with its length)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    table = multipliers(int(lengths.max()), seed=1)
    taken = data[np.repeat(starts, lengths) + inside].astype(np.uint64)
    taken += np.uint64(1)
    taken *= table[inside]
    return mix(np.add.reduceat(taken, first) + multipliers(1, 2)[0] * lengths.astype(np.uint64))


def hash_of(word: str) -> int:
    """The hash that word_hashes gives to this word."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])
