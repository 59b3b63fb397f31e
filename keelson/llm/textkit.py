"""Words and word hashes of Arrow text columns, computed with numpy on whole batches.

Everything is positional: a chunk is the UTF-8 bytes of some rows laid end to end, words are
[start, end) ranges of bytes, and the words of row r are ``first[r]`` to ``first[r + 1] - 1``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text handled at once; a longer single text is a chunk of its own.
CHUNK_BYTES = 2 << 20

# Which bytes belong to words.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)   # ASCII digits and letters, and every byte of other characters
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_low:_high + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Chunk:
    low: int                  # rows low to high - 1 of the batch
    high: int
    data: np.ndarray          # bytes
    offsets: np.ndarray       # of the rows, in data

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's rows in order; nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield Chunk(low, high, raw[at[low]:at[high]], at[low:high + 1] - at[low])
        low = high


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray         # one more than there are rows

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(chunk: Chunk, member: np.ndarray) -> Words:
    """Maximal runs of ``member`` bytes within a row."""
    inside = member[chunk.data]
    n = len(inside)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(chunk.offsets), np.int64))
    begin, end = inside.copy(), np.zeros(n + 1, bool)
    begin[1:] &= ~inside[:-1]
    end[1:] = inside
    end[1:n] &= ~inside[1:]
    cuts = chunk.offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    cuts = cuts[inside[cuts] & inside[cuts - 1]]          # a word ends where its row ends
    begin[cuts] = True
    end[cuts] = True
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end), np.searchsorted(starts, chunk.offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit values, the same on every machine."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Hasher:
    """64-bit hashes of ranges: of bytes, then of words. Range sums of value x base^position,
    divided by base^start, do not depend on where the range lies; arithmetic is modulo 2^64,
    where an odd base has an inverse. One per task: the tables of powers are not shipped."""

    def __init__(self, seed: int = 1, fold: bool = False):
        self.byte = draws(256, seed)
        if fold:
            self.byte = self.byte[LOWER]
        self.base = [int(b) for b in draws(2, seed + 1)]
        self.tables = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2

    def _powers(self, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[k][0]) < n:
            size = max(n, 2 * len(self.tables[k][0]))
            both = []
            for base in (self.base[k], pow(self.base[k], -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps))
            self.tables[k] = tuple(both)
        up, down = self.tables[k]
        return up, down

    def _ranges(self, k: int, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._powers(k, len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])

    def words(self, chunk: Chunk, found: Words) -> np.ndarray:
        return self._ranges(0, self.byte[chunk.data], found.starts, found.ends)

    def grams(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the words ``starts`` to ``ends`` - 1."""
        return self._ranges(1, hashes, starts, ends)


def shingle_starts(found: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every ``n``-word window; a row of fewer words, but not none, is one
    window."""
    counts = np.diff(found.first)
    windows = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    row = np.repeat(np.arange(len(counts)), windows)
    begin = np.cumsum(windows) - windows
    starts = found.first[row] + (np.arange(len(row)) - begin[row])
    return starts, np.minimum(starts + n, found.first[row + 1]), row
