"""Words of whole Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are taken in slices of about a megabyte, never cut, so memory
follows the longest text and not the batch.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def release() -> None:
    """Gives freed memory back to the system at the end of a task: a worker lives on, idle, beside the JVM's next stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function that gives memory back at its end."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        n = max(n + n // 4, 1 << 18)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class SpanHasher:
    """Hashes any span of a byte buffer from running sums."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """The words of some whole texts: byte spans, and which text each is of."""

    data: np.ndarray      # bytes of all texts
    offsets: np.ndarray   # text k is data[offsets[k]:offsets[k + 1]]
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray     # index of each text's first word, and the number of words

    @property
    def hashes(self) -> np.ndarray:
        if not hasattr(self, "_hashes"):
            self._hashes = SpanHasher(self.data)(self.start, self.end)
        return self._hashes


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, offsets, start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def text_slices(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of whole texts, about ``size`` bytes at a time; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return
    _, where, body = column.buffers()
    places = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(places, places[low] + size, side="right")) - 1)
        yield low, high, body[places[low]:places[high]], places[low:high + 1] - places[low]
        low = high


def word_slices(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    for low, high, data, offsets in text_slices(column, size):
        yield low, high, find_words(data, offsets)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each start and length, one after another."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total) - np.repeat(before - start, length)
