"""Texts of an Arrow batch as byte arrays: words, rolling hashes and lengths by numpy, without a loop over characters."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
# Texts are worked on in parts of about so many bytes; a task needs some hundred times as much at most.
CHUNK_BYTES = 500_000
# The bytes that separate words, space and 0x09 to 0x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of every text, one more than texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    values = np.frombuffer(data, dtype=np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return values, offsets - first


def text_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text stands alone."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


Batches = Iterator[pa.RecordBatch]


def release_memory() -> None:
    """Gives memory that is free inside this process back to the system, as far as its libraries can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on the batches of a task, whose worker keeps no free memory for the tasks and stages that follow."""

    @wraps(work)
    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(length: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and those of its inverse."""
    size = 1 << max(16, int(length).bit_length())
    return _powers(size, base)[:length], _powers(size, pow(base, -1, 1 << 64))[:length]


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that all bits depend on all."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


class Rolling:
    """Hash of any byte range of ``data`` in constant time, from running sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.down[starts])

    def grams(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from each place on."""
        count = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:count]) * self.down[:count])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of every word, and for each text the number of words before it (one more than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(stops) + 1, np.searchsorted(first, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """Hash of every word of ``word_spans``: sum of mixed pairs of place and byte.

    No polynomial in the place, so words built against powers modulo 2^64 do not collide. Taken in blocks of words.
    """
    hashes = np.empty(len(starts), dtype=np.uint64)
    for first in range(0, len(starts), block):
        cut = slice(first, first + block)
        sizes = stops[cut] - starts[cut]
        heads = np.cumsum(sizes) - sizes
        span = data[starts[first] : stops[cut][-1]]
        pairs = np.arange(1, sizes.sum() + 1) - np.repeat(heads, sizes)
        pairs <<= 8
        pairs |= span[~IS_SPACE[span]]
        sums = np.add.reduceat(mixed(pairs.view(np.uint64)), heads)
        hashes[cut] = mixed(sums + sizes.astype(np.uint64) * np.uint64(BASE))
    return hashes
