"""Vectorised words and rolling hashes over Arrow text columns (numpy inside Spark tasks).

A word is a run of bytes outside a separator table; all separators are ASCII, so byte scans of
UTF-8 give exact code-point words. Hashes are 64-bit: a polynomial over per-byte random values,
then a finaliser. Work arrays are about 40 bytes per text byte, so texts are taken in chunks of
``CHUNK_BYTES`` (or one text, where a single text is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _table(lower: bool) -> np.ndarray:
    t = splitmix((np.arange(256, dtype=np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))
    if lower:
        t[65:91] = t[97:123]
    return t


_BYTES = {False: _table(False), True: _table(True)}
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
PUNCT = SPACE.copy()     # separators of terms: white space, control and ASCII punctuation
PUNCT[[b for b in range(128) if not chr(b).isalnum()]] = True

_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = []


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64, grown as needed."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inv = pow(_BASE, -1, 1 << 64)
        out = []
        for base in (_BASE, inv):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0][:n], _powers[1][:n]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 byte offsets) of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``limit`` bytes of text each (one row where it is longer)."""
    limit = limit or CHUNK_BYTES
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


class Words(NamedTuple):
    lo: int                 # first row of the chunk
    hi: int                 # one past the last row
    buf: np.ndarray         # the chunk's bytes
    starts: np.ndarray      # byte start of each word in buf
    ends: np.ndarray
    first: np.ndarray       # hi - lo + 1 offsets: words of row r are first[r]..first[r + 1]
    cum: np.ndarray         # prefix sums of weighted bytes (for hashes of parts of words)
    inv: np.ndarray

    def hashes(self, stop: np.ndarray | None = None) -> np.ndarray:
        """Hash of every word, or of its bytes up to ``stop``."""
        end = self.ends if stop is None else stop
        return splitmix((self.cum[end] - self.cum[self.starts]) * self.inv[self.starts])

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))


def words(col: pa.Array, lower: bool = False, separators: np.ndarray = SPACE) -> Iterator[Words]:
    """Words of a string column, chunk by chunk."""
    return raw_words(*text_buffer(col), lower, separators)


def raw_words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = SPACE,
              limit: int | None = None) -> Iterator[Words]:
    """Words of texts given as UTF-8 bytes and row offsets."""
    for lo, hi in chunks(offsets, limit):
        buf = raw[offsets[lo]:offsets[hi]]
        bounds = offsets[lo:hi + 1] - offsets[lo]
        n = len(buf)
        if n == 0:
            z = np.zeros(0, np.int64)
            yield Words(lo, hi, buf, z, z, np.zeros(hi - lo + 1, np.int64), np.zeros(1, np.uint64),
                        np.ones(1, np.uint64))
            continue
        inside = ~separators[buf]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[bounds[:-1][bounds[:-1] < n]] = False
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[bounds[1:][bounds[1:] > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        pw, inv = _pow_tables(n + 1)
        cum = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[lower][buf] * pw[:n], out=cum[1:])
        yield Words(lo, hi, buf, starts, ends, np.searchsorted(starts, bounds), cum, inv)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (length len(h) - k + 1; empty if too short)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= U(0x9E3779B97F4A7C15)
        acc += h[i:i + n]
    return splitmix(acc)


def row_windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of every k-word window that stays inside one row."""
    w = windows(h, k)
    if not len(w):
        return np.zeros(0, np.int64), w
    count = np.maximum(np.diff(first) - k + 1, 0)
    ok = np.zeros(len(h) + 1, np.int64)
    np.add.at(ok, first[:-1], (count > 0).astype(np.int64))
    np.add.at(ok, first[:-1] + count, -(count > 0).astype(np.int64))
    at = np.flatnonzero(np.cumsum(ok[:-1])[:len(w)] > 0)
    return at, w[at]
