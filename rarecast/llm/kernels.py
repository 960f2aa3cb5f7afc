"""Word and shingle hashing over Arrow string columns, vectorised with numpy.

Words are maximal runs of bytes outside the separator class; A-Z count as a-z.  A word's hash
is a 64-bit polynomial over a table of mixed byte values, finalised with a bit mixer, so it is
the same in every task and on every machine.  Columns are cut into chunks of about
``CHUNK_BYTES`` (one longer text makes a chunk of its own), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 19

IS_SEP = np.zeros(256, bool)
IS_SEP[list(b" \t\n\x0b\x0c\r")] = True
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_BYTE[65:91] = _BYTE[97:123]
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64; kept for chunks of the usual size only."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(max(n, CHUNK_BYTES + 1), b, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 2 * CHUNK_BYTES:
        _POWERS[:] = made
    return made[0], made[1]


class Words(NamedTuple):
    row: np.ndarray      # text of each word, counted from the chunk's first
    start: np.ndarray    # first byte
    end: np.ndarray      # byte after the last
    hash: np.ndarray
    first: np.ndarray    # of each text: its first word; one more entry closes the last text


class Chunk(NamedTuple):
    at: int              # row of the column where the chunk begins
    n: int               # rows
    buf: np.ndarray      # UTF-8 bytes
    offs: np.ndarray     # n + 1 offsets into buf

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offs[i]:self.offs[i + 1]].tobytes()


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Nulls count as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, wide)[column.offset:column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        to = min(to, n, at + CHUNK_ROWS)
        yield Chunk(at, to - at, buf[offs[at]:offs[to]], offs[at:to + 1] - offs[at])
        at = to


def byte_spans(c: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` bytes; runs end with their text."""
    n = len(c.buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = c.offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hash(c: Chunk, start: np.ndarray, end: np.ndarray, byte_values: np.ndarray = _BYTE,
              skip: np.ndarray | None = None) -> np.ndarray:
    """Hash of the bytes [start, end), the same wherever they stand.  Bytes marked in ``skip`` add
    nothing (positions still count)."""
    power, inverse = _powers(len(c.buf) + 1)
    v = byte_values[c.buf]
    if skip is not None:
        v[skip] = 0
    v *= power[:len(v)]
    total = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v, out=total[1:])
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _U(_BASE))


def words(c: Chunk, separators: np.ndarray = IS_SEP) -> Words:
    start, end = byte_spans(c, ~separators[c.buf])
    row = np.searchsorted(c.offs[1:], start, "right")
    first = np.searchsorted(row, np.arange(c.n + 1))
    return Words(row, start, end, span_hash(c, start, end), first)


def combine(parts: list[np.ndarray], salt: int) -> np.ndarray:
    """Order-sensitive hash of aligned hashes."""
    h = np.full(len(parts[0]), salt, np.uint64) * _U(_BASE)
    for p in parts:
        h = mix64(h * _U(0xD6E8FEB86659FD93) + p)
    return h


def shingles(w: Words, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each run of ``k`` words.  A text with fewer words, but one at least, has its
    whole sequence as its one shingle."""
    m = len(w.hash) - k + 1
    if m > 0:
        inside = w.row[:m] == w.row[k - 1:]
        row = w.row[:m][inside]
        h = combine([w.hash[i:i + m][inside] for i in range(k)], k)
    else:
        row, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        hs = np.empty(len(short), np.uint64)
        for n in range(1, k):
            of = np.flatnonzero(count[short] == n)
            at = w.first[short[of]]
            hs[of] = combine([w.hash[at + i] for i in range(n)], n)
        row, h = np.concatenate([row, short]), np.concatenate([h, hs])
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
    return row, h


def order_by(row: np.ndarray, rank: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Order by (row, rank, hash) from one sort of packed keys; ``rank`` below 256, rows below 2^20."""
    if rank is None:
        key = (row.astype(np.uint64) << _U(44)) | (h >> _U(20))
    else:
        key = (row.astype(np.uint64) << _U(44)) | (rank.astype(np.uint64) << _U(36)) | (h >> _U(28))
    order = np.argsort(key)
    k, s = key[order], h[order]
    tied = np.flatnonzero((k[1:] == k[:-1]) & (s[1:] < s[:-1]))
    for t in tied:                                  # packed keys hold only part of the hash
        lo, hi = np.searchsorted(k, k[t], "left"), np.searchsorted(k, k[t], "right")
        order[lo:hi] = order[lo:hi][np.argsort(h[order[lo:hi]], kind="stable")]
    return order


def distinct_per_row(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes sorted and distinct inside each row, n_rows + 1 offsets)."""
    order = order_by(row, None, h)
    r, s = row[order], h[order]
    keep = np.ones(len(s), bool)
    if len(s) > 1:
        keep[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    r, s = r[keep], s[keep]
    return s, np.searchsorted(r, np.arange(n_rows + 1))


class HashIndex:
    """Positions of well-mixed 64-bit keys in a sorted table, by a radix table over their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(8, int(len(keys)).bit_length() + 1)
        self.shift = _U(64 - bits)
        self.start = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of each hash, -1 where it is missing."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys):
            return out
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        todo = np.flatnonzero(at < end)
        at, end, h = at[todo], end[todo], h[todo]
        while len(todo):
            hit = self.keys[at] == h
            out[todo[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end)
            todo, at, end, h = todo[more], at[more], end[more], h[more]
        return out


def list_array(values: np.ndarray, offs: np.ndarray, kind=pa.int64()) -> pa.Array:
    """Arrow list column from flat values and offsets; unsigned hashes turn into signed longs."""
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))
