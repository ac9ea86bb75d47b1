"""Flat, vectorised text primitives for Arrow tasks.

A chunk of documents is one byte array plus offsets; words, their hashes and
n-word shingles are computed for all documents of the chunk at once. Chunks
are bounded by bytes, so memory does not depend on the batch size; a document
longer than the bound is a chunk of its own and is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLDED = _BYTE[LOWER]
_BASE = 0x9E3779B97F4A7C1B  # odd, 3 mod 8
_INV = pow(_BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = _powers(base, max(n, 1 << 16))
    return _POWERS[base][:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if len(off) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batches, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        _, off = text_bytes(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
            j = min(n, max(j, i + 1))
            yield batch.slice(i, j - i)
            i = j


# Also ASCII punctuation and control characters as separators.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = True
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False


class Words:
    """Words of a chunk, runs of bytes outside ``separators`` (by default
    ``[^\\x20\\x09-\\x0D]+``): ``start``, ``end`` (byte positions), ``doc`` (row),
    ``hash`` (64 bits, ASCII case folded) and ``count`` (words per row)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACE):
        n = len(data)
        space = separators[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        word = ~space
        begin, stop = word.copy(), word.copy()
        if n:
            begin[1:] &= space[:-1] | edge[1:n]
            stop[:-1] &= space[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=len(off) - 1)
        self._data = data

    @cached_property
    def hash(self) -> np.ndarray:
        n = len(self._data)
        if not n:
            return np.empty(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_FOLDED[self._data] * powers(_BASE, n), out=total[1:])
        return mix((total[self.end] - total[self.start]) * powers(_INV, n)[self.start])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles as ``(doc, hash)``, sorted by both.

    A row with fewer words has its whole word sequence as its one shingle; a
    row without words has none.
    """
    h, doc, count = words.hash, words.doc, words.count
    first = np.concatenate(([0], np.cumsum(count)))
    w = [np.uint64(pow(_BASE, 3 * k + 5, 1 << 64)) for k in range(size)]
    sets, docs = [], []
    if len(h) >= size:
        m = len(h) - size + 1
        full = doc[:m] == doc[size - 1:]
        acc = np.zeros(m, np.uint64)
        for k in range(size):
            acc += h[k:k + m] * w[k]
        sets.append(mix(acc[full]))
        docs.append(doc[:m][full])
    for n in range(1, size):
        rows = np.flatnonzero(count == n)
        acc = np.full(len(rows), n, np.uint64)
        for k in range(n):
            acc += h[first[rows] + k] * w[k]
        sets.append(mix(acc + np.uint64(0x632BE59BD9B4E019)))
        docs.append(rows)
    s, d = np.concatenate(sets), np.concatenate(docs)
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    return d[keep], s[keep]


def row_sums(values: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``values`` per row; ``doc`` is sorted. Keeps the dtype (wraps)."""
    out = np.zeros((rows, *values.shape[1:]), values.dtype)
    if len(values):
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        out[doc[at]] = np.add.reduceat(values, at, axis=0)
    return out
