"""Stretches of bytes, told apart by 128 bits, and a table of them, in numpy.

Whole groups of texts are cut, hashed and looked up by array operations; no
Python object is made for a stretch that the table already holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are in work at once.
SLICE = 1 << 19

_U = np.uint64
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_known: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``; a worker keeps the longest row it made."""
    row = _known.get(int(base))
    if row is None or len(row) < n:
        row = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(max(n, 2 * SLICE), base, _U)]))
        if n <= 8 * SLICE:
            _known[int(base)] = row
    return row[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def white(data: np.ndarray) -> np.ndarray:
    """Where the bytes are ASCII white space."""
    return (data == 32) | ((data - np.uint8(9)) < 5)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lowered."""
    return data + (((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))


def hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each stretch a hash of its bytes and length, and its first eight bytes."""
    n = len(data)
    total = np.zeros(n + 1, _U)
    np.cumsum(powers(_P, n) * (data.astype(_U) + _U(1)), dtype=_U, out=total[1:])
    size = (stop - start).astype(_U)
    h = mixed((total[stop] - total[start]) * powers(_INVERSE, n + 1)[start] + size * _U(0x94D049BB133111EB))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.ndarray((n + 1,), "<u8", padded, 0, (1,))[start]
    cut = (_U(8) - np.minimum(size, _U(8))) * _U(8)
    first = np.where(size > 0, (first << np.minimum(cut, _U(63))) , _U(0))
    return np.where(h == 0, _U(1), h), first


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space; ``bounds`` of texts part them."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~white(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    stop = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, stop


class Table:
    """Numbers of known stretches, in the order in which they were added."""

    def __init__(self, room: int):
        self.bits = max(10, (2 * room).bit_length())
        self.key = np.zeros(1 << self.bits, _U)
        self.entry = np.full(1 << self.bits, -1, np.int32)
        self.first = np.zeros(room, _U)
        self.room, self.size = room, 0

    def find(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The number of each stretch, -1 where it isn't known."""
        out = np.full(len(h), -1, np.int64)
        at, slot = np.arange(len(h)), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(at):
            key, entry = self.key[slot], self.entry[slot]
            hit = (key == h[at]) & (self.first[entry] == first[at])
            out[at[hit]] = entry[hit]
            on = ~hit & (key != 0)
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, h: np.ndarray, first: np.ndarray) -> None:
        """Adds distinct stretches that aren't known; there must be room."""
        n = len(h)
        number = np.arange(self.size, self.size + n, dtype=np.int32)
        self.first[self.size : self.size + n] = first
        self.size += n
        at, slot = np.arange(n), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(at):
            free = self.key[slot] == 0
            self.key[slot[free]] = h[at[free]]
            self.entry[slot[free]] = number[at[free]]
            done = self.entry[slot] == number[at]
            at, slot = at[~done], (slot[~done] + 1) & ((1 << self.bits) - 1)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, one after the other, and their bounds.  Null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.large_binary())
    _, offsets, values = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(bounds: np.ndarray):
    """Ranges of rows of at most ``SLICE`` bytes, or of one row."""
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
        yield at, to
        at = to
