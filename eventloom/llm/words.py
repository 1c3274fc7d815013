"""Words of whole texts as numpy arrays: split, hashed and counted over the bytes of an Arrow batch.

A word is a run without ASCII white space (`[^\\x20\\x09-\\x0D]+`). No word of UTF-8 is cut by that, so the work is
done on bytes. A null text has no words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes (a longer text is a slice of its own), which bounds memory.
SLICE_BYTES = 1 << 19
#: A row counts as so many bytes more.
ROW_BYTES = 256

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that begin a code point.
LEADS = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int = 0) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD)) + np.uint64(seed * 0x632BE5AB & _MASK))


BYTE_KEYS = keys(256)
FOLDED_KEYS = BYTE_KEYS.copy()
FOLDED_KEYS[65:91] = BYTE_KEYS[97:123]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


class Hasher:
    """Hashes of any byte ranges of one buffer, each from two lookups in a running sum."""

    def __init__(self, data: np.ndarray, table: np.ndarray = BYTE_KEYS):
        power, self.inverse = _power_tables(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * power[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Texts:
    """Some rows of a batch: their bytes, where each row begins, and their words."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        wide = column.type in (pa.large_string(), pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
        offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]] if len(column) else data[:0]
        self.rows = offsets - offsets[0] if len(column) else np.zeros(1, np.int64)
        self.n = len(column)
        self._split()

    def _split(self) -> None:
        solid = ~SPACE[self.data]
        self.solid = solid
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.rows] = True
        start, end = solid.copy(), solid.copy()
        if len(solid):
            start[1:] &= ~solid[:-1] | edge[1:-1]
            end[:-1] &= ~solid[1:] | edge[1:-1]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        #: Words of row i: first[i] to first[i + 1].
        self.first = np.searchsorted(self.start, self.rows)
        self.counts = np.diff(self.first)

    def row_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.rows])

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `size` bytes of text."""
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths + ROW_BYTES) // size)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of width words that lies in one row, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = keys(width, seed=7) | np.uint64(1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : n + k] * factors[k]
    whole = np.ones(n, bool)
    for k in range(1, width):
        at = first[1:-1] - k
        whole[at[(at >= 0) & (at < n)]] = False
    at = np.flatnonzero(whole)
    return mix(out[at]), at


def release() -> None:
    """Gives back what a finished task has allocated: Python workers live on beside the tasks that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
