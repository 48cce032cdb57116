"""Per-worker memory of what has been computed for a word, as flat arrays.

Text repeats its words, so work per distinct word is done once in a Python worker and gathered per text.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

#: Distinct words that a worker remembers before it starts afresh, and characters of text handled at a time.
MEMORY_WORDS, CHUNK_CHARS = 150_000, 500_000


_held: dict[object, Any] = {}


def held(name: object, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task under a name. Whatever it keeps under another one goes first, so that a
    worker which is used again by the next step does not hold the tables of those before."""
    if name not in _held:
        if _held:
            _held.clear()
            trim()
        _held[name] = make()
    return _held[name]


def trim() -> None:
    """Gives free memory back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        return


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that gives free memory back when it ends, before the worker goes on."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters each; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every row, one row after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ends + counts, counts)


class WordTable:
    """Values of words, kept as one flat array; ``make`` computes them for new words as (values, counts)."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype, limit: int = MEMORY_WORDS):
        self.make, self.limit, self.dtype = make, limit, dtype
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.values, self.used = np.zeros(1024, self.dtype), 0
        self.starts, self.counts = np.zeros(256, np.int64), np.zeros(256, np.int64)

    def codes(self, words: Iterable[str]) -> np.ndarray:
        """A number for every word; good until the next call that adds words."""
        words = words if isinstance(words, list) else list(words)
        new = list(set(words).difference(self.index))
        if new and len(self.index) + len(new) > self.limit and self.index:
            self.clear()
            new = list(set(words))
        if new:
            self._add(new)
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of coded words one after the other, and how many each has."""
        counts = self.counts[codes]
        return self.values[expand(self.starts[codes], counts)], counts

    def _add(self, new: list[str]) -> None:
        values, counts = self.make(new)
        first, last = len(self.index), len(self.index) + len(new)
        self.index.update(zip(new, range(first, last), strict=True))
        if self.used + len(values) > len(self.values):
            self.values = np.resize(self.values, 2 * (self.used + len(values)))
        if last > len(self.counts):
            self.starts, self.counts = np.resize(self.starts, 2 * last), np.resize(self.counts, 2 * last)
        self.values[self.used : self.used + len(values)] = values
        self.counts[first:last] = counts
        self.starts[first:last] = self.used + np.cumsum(counts) - counts
        self.used += len(values)


class HashIndex:
    """Open-addressing map from 128-bit hashes, as two 64-bit halves, to numbers from 0 on; all calls take arrays."""

    def __init__(self, bits: int = 16):
        self.clear(bits)

    def clear(self, bits: int = 16) -> None:
        self.bits, self.size = bits, 0
        self.a, self.b = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int32)

    def _slots(self, a: np.ndarray) -> np.ndarray:
        return (a >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of keys; -1 for a key that is not there."""
        mask = (1 << self.bits) - 1
        slot, out = self._slots(a), np.full(len(a), -1, np.int64)
        todo = np.arange(len(a))
        while len(todo):
            at = slot[todo]
            got = self.value[at]
            hit = (self.a[at] == a[todo]) & (self.b[at] == b[todo]) & (got >= 0)
            out[todo[hit]] = got[hit]
            todo = todo[~hit & (got >= 0)]
            slot[todo] = (slot[todo] + 1) & mask
        return out

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Gives distinct keys that are not there the next numbers, in their order."""
        while self.size + len(a) > (1 << self.bits) * 0.6:
            old_a, old_b, old_v = self.a, self.b, self.value
            size = self.size
            self.clear(self.bits + 1)
            keep = old_v >= 0
            self._put(old_a[keep], old_b[keep], old_v[keep])
            self.size = size
        self._put(a, b, np.arange(self.size, self.size + len(a), dtype=np.int32))
        self.size += len(a)

    def _put(self, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        slot, todo = self._slots(a), np.arange(len(a))
        while len(todo):
            at = slot[todo]
            free = self.value[at] < 0
            self.value[at[free]] = value[todo[free]]  # of keys that meet in a slot the last one stays
            won = free & (self.value[at] == value[todo])
            self.a[at[won]], self.b[at[won]] = a[todo[won]], b[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & mask
