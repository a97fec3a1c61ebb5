"""Words of an Arrow text column as arrays: byte spans and 64-bit hashes, no Python object per word.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a polynomial over its bytes modulo
2**64, read from one running sum per chunk, and then mixed. All steps work on whole arrays, in chunks of
rows of about ``CHUNK_BYTES`` text, so the memory of a task doesn't grow with its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
#: Rows of a chunk at most: a row number fits 16 bits.
CHUNK_ROWS = 1 << 16

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers under which near values become unrelated ones."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_LOW = 14


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers below 2**_LOW, and powers of base**(2**_LOW): two short tables make up any power below n."""
    high = _powers(pow(base, 1 << _LOW, 1 << 64), 1 << max(n >> _LOW, 1).bit_length())
    return _powers(base, 1 << _LOW), high


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans: a polynomial over the bytes, from one running sum, and mixed."""
    n = len(data)
    low, high = _tables(_BASE, n)
    size = 1 << _LOW
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    for k in range(0, n, size):
        part = terms[k : k + size]
        part *= low[: len(part)] * high[k >> _LOW]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    low, high = _tables(_BASE_INVERSE, n)
    hashed = (sums[end] - sums[start]) * (low[start & (size - 1)] * high[start >> _LOW])
    return mix(hashed + (end - start).astype(np.uint64))


class Words(NamedTuple):
    """Words of a chunk in order. ``row`` counts from 0 in the chunk; ``start`` and ``end`` are bytes of ``data``."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    bounds: np.ndarray

    def first_of_row(self) -> np.ndarray:
        """For each row of the chunk, and one past the last, the number of its first word."""
        return np.searchsorted(self.row, np.arange(len(self.bounds)))


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last, bytes, row bounds) of each chunk; a null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
        to = min(max(to, at + 1), at + CHUNK_ROWS, len(column))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = False, kinds: np.ndarray | None = None) -> Words:
    """The words of a chunk. ``lower`` folds A-Z before hashing.

    ``kinds`` (0, 1 or 2 for each byte) cuts words once more wherever bytes of kind 1 and 2 are neighbours.
    """
    n = len(data)
    if lower:
        data = _LOWER[data]
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, none.astype(np.uint64), data, bounds)
    solid = ~_SPACE[data]
    opens = np.empty(n, dtype=bool)
    opens[0] = True
    opens[1:] = ~solid[:-1]
    opens[bounds[:-1][bounds[:-1] < n]] = True
    if kinds is not None:
        kind = kinds[data]
        opens[1:] |= kind[:-1] + kind[1:] == 3
    closes = np.empty(n, dtype=bool)
    closes[:-1] = opens[1:] | ~solid[1:]
    closes[-1] = True
    start = np.flatnonzero(solid & opens)
    end = np.flatnonzero(solid & closes) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    return Words(row, start, end, span_hashes(data, start, end), data, bounds)


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, whether or not they lie in one row."""
    count = max(len(hashes) - n + 1, 0)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= _STEP
        out += hashes[k : k + count]
    return mix(out)


def least_in_window(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value of each window of ``width`` values, and its first place in the window."""
    count = max(len(x) - width + 1, 0)
    least, place = x[:count].copy(), np.zeros(count, dtype=np.int64)
    for k in range(1, width):
        other = x[k : k + count]
        less = other < least
        least[less] = other[less]
        place[less] = k
    return least, place


def split_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``key`` so that no value of it lies in two tables.

    What is held back between batches is one group, so its size must be bounded by the caller.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key))
        last = column[batch.num_rows - 1]
        cut = int(pc.index(column, last).as_py())
        if cut == 0 and held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() == last.as_py():
            held.append(batch)
            continue
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
