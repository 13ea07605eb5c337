"""Texts of an Arrow batch as flat numpy arrays: bytes, words, word hashes.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return, which is ``[^\\x20\\x09-\\x0D]+`` over characters too, because
no byte of a longer UTF-8 character is below 0x80.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

# Bytes handled at once. The work arrays take some thirty times as much.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and n + 1 offsets into them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    n = len(column)
    if n == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library


def give_back() -> None:
    """Return to the system what Arrow and the allocator keep of freed memory.

    A Python worker serves many tasks and stages; else it stays as large as it ever was.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds less at once.

    What was kept for one is given back before the next.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            give_back()


def byte_pieces(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The same texts in parts of at most ``limit`` bytes, or of one longer text.

    What Arrow kept for a part is given back before the next one, all else at the end.
    """
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    for first, last in row_slices(np.concatenate([[0], np.cumsum(sizes)]), limit):
        yield column.slice(first, last - first)
        pa.default_memory_pool().release_unused()
    give_back()


def fold_case(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _FOLD[data]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each, or of one longer row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and n + 1 offsets of each row's words among them."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # a row's edge also ends a word
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit integers over all their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; the spans are ascending and apart.

    A polynomial in the bytes, from differences of one running sum per slice.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        base = starts[i]
        piece = data[base : ends[j - 1]]
        powers = np.multiply.accumulate(np.full(len(piece), _BASE, np.uint64))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        back = np.multiply.accumulate(np.full(len(piece), _INVERSE, np.uint64))[a]
        h = (sums[b] - sums[a]) * back
        out[i:j] = mixed(h + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each item, the row whose offsets enclose it."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by row, 0 for rows without any."""
    out = np.zeros(len(offsets) - 1, np.float64)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    if len(filled):
        out[filled] = np.add.reduceat(values, offsets[filled], dtype=np.float64)
    return out
