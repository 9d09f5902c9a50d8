"""Words of whole text batches in numpy: spans, 64-bit hashes and a hash table, without a loop over words.

A batch's texts stand one after another in one byte buffer (as Arrow holds them). A word of at most 64 bytes is
hashed eight bytes at a time, all words together: each step mixes the next eight bytes into the word's state by a
64-bit finaliser. So words of one length up to eight bytes never collide, and others do with the chance of random
64-bit values; no structure of their letters (periodic, self-similar) matters. Longer words take xxh3 of their
bytes. Equal spans have equal hashes wherever they stand.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

from docloom.llm.common import mix64

_settled: list[bool] = []


def _return_freed_memory() -> None:
    """In a task's Python worker, once: large arrays go back to the system when freed, so a heap stays near what it holds."""
    if _settled or TaskContext.get() is None:
        return
    _settled.append(True)
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD, fixed from now on
    except (OSError, AttributeError):
        pass  # another C library


_U = np.uint64
#: Bytes of a word that go into one step of its hash; longer words than LONG take xxh3.
_STEP, LONG = 8, 64
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
#: As bytes: white space of the contract, and values under which A-Z equal a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffers(column: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows, each run of about ``most`` bytes or one row; null text is empty."""
    _return_freed_memory()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for begin in range(0, len(column), 1024):  # only so many rows are copied at once
        part = column.slice(begin, 1024).cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(part.buffers()[2], np.uint8) if part.buffers()[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(part):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            yield begin + at, raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to
    pa.default_memory_pool().release_unused()


class Spans:
    """Words of a buffer: starts, ends, the row of each (as first word index of every row)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~SPACE[data]
        begins, ends = word.copy(), word.copy()
        if n:
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < n)]
            begins[cuts] |= word[cuts]
            ends[cuts - 1] |= word[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        #: words of row r: first[r] to first[r + 1]
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, folded: bool = True) -> np.ndarray:
        """A hash of each word; folded: A-Z count as a-z."""
        size = self.ends - self.starts
        h = mix64(size.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        if not len(h):
            return h
        data = LOWER[self.data] if folded else self.data
        padded = np.concatenate((data, np.zeros(_STEP, np.uint8)))
        eight = np.ndarray(len(data), "<u8", padded, strides=(1,))  # the eight bytes from each position on
        on = slice(None) if size.max() <= LONG else np.flatnonzero(size <= LONG)
        at, left = self.starts[on], size[on]
        while True:
            h[on] = mix64(h[on] ^ (eight[at] & _KEEP[np.minimum(left, _STEP)]))
            more = np.flatnonzero(left > _STEP)
            if not len(more):
                break
            on = more if isinstance(on, slice) else on[more]
            at, left = at[more] + _STEP, left[more] - _STEP
        for i in np.flatnonzero(size > LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(data[self.starts[i] : self.ends[i]].tobytes())
        return h


class Table:
    """An open-addressing map from nonzero 64-bit hashes to ints, read and filled by whole arrays."""

    def __init__(self, bits: int = 16, most_bits: int = 22):
        self.bits, self.most_bits, self.n = bits, most_bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def get(self, h: np.ndarray) -> np.ndarray:
        """The value of each hash; -1: absent."""
        mask = (1 << self.bits) - 1
        slot = (h >> _U(64 - self.bits)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.values[slot], np.int32(-1))
        open_ = np.flatnonzero((key != h) & (key != 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & mask
            key, want = self.keys[slot], h[open_]
            hit = key == want
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (key != 0)
            open_, slot = open_[on], slot[on]
        return out

    def put(self, h: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct hashes that are absent."""
        while (self.n + len(h)) * 3 > 1 << self.bits:
            keep = self.keys != 0
            old = self.keys[keep], self.values[keep]
            self.bits += 1
            self.keys, self.values, self.n = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32), 0
            self.put(*old)
        mask = (1 << self.bits) - 1
        self.n += len(h)
        slot = (h >> _U(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            won = self.keys[slot] == h
            self.values[slot[won]] = values[won]
            h, values, slot = h[~won], values[~won], (slot[~won] + 1) & mask

    def full(self) -> bool:
        return self.n * 3 > 1 << self.most_bits


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] numbers of each, one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)
