"""Vectorised work on the UTF-8 bytes of a batch of texts.

Words are hashed by a polynomial over their bytes whose prefix sums are taken
once for a whole slice, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; bounds the memory of a task.
SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs get unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, data


def sliced(batches: Iterator[pa.RecordBatch], text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``most`` bytes of text, a row at least."""
    for batch in batches:
        offsets, low = utf8(batch.column(text))[0], 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def give_back() -> None:
    """Freed memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(work: Work) -> Work:
    """``work`` that gives freed memory back to the system at the end of a task.

    Worker processes outlive their stage, and what their allocators hold on to counts against the executor in the next one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


@dataclass
class Block:
    """Word hashes of some consecutive rows of a batch."""

    first: int              # row of the batch
    rows: int
    words: np.ndarray       # uint64, all words of these rows
    offsets: np.ndarray     # rows + 1 positions in words


class WordHasher:
    """Splits texts at ASCII white space and hashes each word."""

    def __init__(self, lower: bool = False, slice_bytes: int = SLICE_BYTES):
        self.lower, self.slice_bytes, self.powers = lower, slice_bytes, Powers(_BASE)

    def blocks(self, column: pa.Array) -> Iterator[Block]:
        offsets, data = utf8(column)
        n, low = len(offsets) - 1, 0
        while low < n:
            high = int(np.searchsorted(offsets, offsets[low] + self.slice_bytes, "right")) - 1
            high = min(max(high, low + 1), n)
            yield self._block(low, offsets[low:high + 1], data)
            low = high

    def _block(self, first: int, offsets: np.ndarray, data: np.ndarray) -> Block:
        buffer = data[offsets[0]:offsets[-1]]
        bounds = offsets - offsets[0]
        rows = len(offsets) - 1
        if not len(buffer):
            return Block(first, rows, np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
        if self.lower:
            buffer = LOWER[buffer]
        inside = ~WHITE[buffer]
        edge = np.zeros(len(buffer) + 1, dtype=bool)
        edge[bounds] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = self.powers.to(len(buffer))
        sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[buffer] * up, out=sums[1:])
        words = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
        return Block(first, rows, words, np.searchsorted(starts, bounds))


def gram_hashes(words: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Rolling polynomial hash of every run of ``size`` words, rows not yet respected."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    up, down = powers.to(len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:len(words) - size + 1])


def word_powers() -> Powers:
    return Powers(_WORD_BASE)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total) - before + np.repeat(starts, counts)


def planes(values: np.ndarray) -> bytes:
    """Bytes by significance, so that the compression of a shuffle finds the zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def fresh(columns: Sequence[str], wanted: str) -> str:
    """A column name that none of ``columns`` equals, whatever the case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
