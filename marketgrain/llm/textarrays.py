"""Texts as flat numpy arrays: words, word hashes and ragged gathers.

A column of texts is taken as one byte array with offsets, as Arrow holds it, so
no Python object is made per word. Work goes in slices of a few megabytes, which
bounds the memory of a task whatever the length of its texts (one text is never
cut, so a single huge text is a slice of its own).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 2 << 20
U = np.uint64

_rng = np.random.default_rng(20240607)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NO_LETTER = np.ones(256, dtype=bool)  # bytes of no letter; all beyond ASCII count as letters
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False
_powers: dict[str, np.ndarray] = {}


def give_back() -> None:
    """Return to the system what arrays no longer use: workers live on and serve other
    stages, and both allocators keep what small arrays leave."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freed(function: Callable) -> Callable:
    """The same Arrow function, giving a task's memory back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, int(n).bit_length())
        with np.errstate(over="ignore"):
            for key, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                out = np.full(size, base, dtype=np.uint64)
                out[0] = 1
                _powers[key] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows whose texts hold about ``limit`` bytes."""
    for batch in batches:
        _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(n, max(start + 1, stop))
            yield batch.slice(start, stop - start)
            start = stop


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, breaks: np.ndarray = SPACE):
    """(starts, ends, row, hash) of every run of bytes that do not break words
    (white space, unless said otherwise).

    ``row`` is the number of the text. A-Z count as a-z if ``lower``. Words never
    span two texts.
    """
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n == 0:
        return empty, empty, empty, np.zeros(0, np.uint64)
    solid = ~breaks[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, row, spans(LOWER[data] if lower else data, starts, ends)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal contents wherever they stand."""
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ragged runs, one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths) + np.arange(total)


def sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sum of values by row number."""
    return np.bincount(row, weights=values, minlength=n)


def firsts(codes: np.ndarray, n: int) -> np.ndarray:
    """Where each code 0..n-1 stands first."""
    out = np.empty(n, dtype=np.int64)
    out[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return out
