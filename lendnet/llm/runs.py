"""Periodic runs of words: online dyadic square catching.

Words are appended in order. Whenever a block of 2**k words is complete (at a multiple ``e`` of 2**k), its
catcher compares that suffix with the window of the same length every q words back, for 2**k <= q < 2**(k + 1).
A match on both ends of a period means that the last 2q words are a square. The square stays with the run that
already repeats at a divisor of q, if one holds it; otherwise its comparison advances by the words appended after
``e`` until one differs (and back over the words before the square), and all squares met on the way merge into
that run. A run of period q and length >= 3q has a boundary ``e`` of its level 2q words or more behind its start,
so no run of exponent 3 or more is missed.

The comparisons of one level are evaluated for all blocks of a batch of texts at once: window names of length
2**k come from those of half the length, and one strided comparison per level fires all catchers. Work is
O(n log n) for n words whatever repeats; window names only propose squares, and extents are compared word by word
(by 64-bit word hashes). Memory is about 40 bytes a word of a chunk (``CHUNK_WORDS`` words, or one longer text).

Cases: null or empty text has no words and no run; a text of any length is taken whole; a whole text may be one
run; equal best runs are the caller's to rank (runs come sorted by start, then period); repeated rows and ids are
separate rows; an empty table gives an empty table; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import ship
from lendnet.llm.words import splitmix

U = np.uint64
CHUNK_WORDS = 1 << 18
SLICE = 1 << 20            # bytes of a text whose words exist as objects at one time
MIN_EXPONENT = 4
MIN_LENGTH = 6
BLANK = re.compile(rb"[\x20\x09-\x0d]")


def slices(raw: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """Words of a text, in lists of about ``size`` bytes cut at separators."""
    at = 0
    while len(raw) - at > size:
        cut = BLANK.search(raw, at + size)
        if cut is None:
            break
        yield raw[at:cut.start()].split()
        at = cut.end()
    yield raw[at:].split()


def word_ids(raw: bytes) -> np.ndarray:
    """One 64-bit hash per word (equal within a Python process)."""
    parts = [np.fromiter(map(hash, w), np.int64, len(w)) for w in slices(raw)]
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _advance(t: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """How many words each comparison T[at] = T[at - q] holds when it advances by ``step`` (+1 or -1) words.

    All live comparisons take a word at a time; the few that outlive 16 words go on in doubling strides."""
    n = len(t)
    held = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    for _ in range(16):
        pos = at[live] + step * held[live]
        ok = (pos < n) & (pos - q[live] >= 0)
        live, pos = live[ok], pos[ok]
        live = live[t[pos] == t[pos - q[live]]]
        if not len(live):
            return held
        held[live] += 1
    for i in live.tolist():
        period, stride = int(q[i]), 32
        while True:
            pos = int(at[i] + step * held[i])
            room = n - pos if step > 0 else pos - period + 1
            take = min(stride, room)
            if take <= 0:
                break
            if step > 0:
                differ = t[pos:pos + take] != t[pos - period:pos - period + take]
            else:
                differ = (t[pos - take + 1:pos + 1] != t[pos - period - take + 1:pos - period + 1])[::-1]
            first = int(differ.argmax())
            if differ[first]:
                held[i] += first
                break
            held[i] += take
            stride *= 2
    return held


def find_runs(t: np.ndarray, longest: int, min_exponent: int = MIN_EXPONENT,
              min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of every run of word names ``t``, by start, then period.

    ``longest`` is the length of the longest text in ``t``; texts are separated by names that occur once."""
    if min_exponent < 3:
        raise ValueError("catchers need three periods: min_exponent >= 3")
    n = len(t)
    name = t.view(np.uint64).copy()            # names of the windows of 2**k words
    found: list[np.ndarray] = []
    k = 0
    while 1 << k <= longest // min_exponent:
        size = 1 << k
        if k:
            half = size >> 1
            name = splitmix(name[:len(name) - half] * U(0x9E3779B97F4A7C15) + name[half:])
        blocks = n // size
        # catcher of the block that ends at e = (j + 1) * size against windows that start q words before it,
        # size <= q < 2 * size: starts (j - 2) * size + 1 .. (j - 1) * size
        if blocks >= 3:
            own = name[2 * size:blocks * size:size][:blocks - 2]
            back = np.lib.stride_tricks.as_strided(
                name[1:], (blocks - 2, size), (size * name.strides[0], name.strides[0]), writeable=False)
            j, lag = np.nonzero(back == own[:, None])
            e, q = (j + 3) * size, 2 * size - 1 - lag
            ok = e >= 2 * q
            e, q = e[ok], q[ok]
            ok = name[e - 2 * q] == name[e - q]       # the first 2**k words of both halves: a square
            e, q = e[ok], q[ok]
            if len(e) and found:
                # at most one run of a smaller period holds the last 2 * size words before a boundary
                owner = np.zeros(n // size + 1, np.int64)
                known = np.concatenate(found)
                for s, m, p in known[known[:, 1] >= 2 * size].tolist():
                    owner[-(-(s + 2 * size) // size):(s + m) // size + 1] = p
                p = owner[e // size]
                ok = (p == 0) | (q % np.maximum(p, 1) != 0)
                e, q = e[ok], q[ok]
            if len(e):
                order = np.lexsort((e, q))
                e, q = e[order], q[order]
                new = np.ones(len(e), bool)           # squares of one period at adjoining boundaries: one run
                new[1:] = (q[1:] != q[:-1]) | (e[1:] - e[:-1] != size)
                e, q = e[new], q[new]
                stop = e + _advance(t, e, q, 1)
                start = e - _advance(t, e - 1, q, -1) - q
                rows = np.unique(np.stack([start, stop - start, q], axis=1), axis=0)
                found.append(rows[rows[:, 1] >= min_exponent * rows[:, 2]])
        k += 1
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[rows[:, 1] >= min_length]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _kept_words(raw: bytes, n: int, runs: np.ndarray) -> bytes:
    """The text's words, joined by one blank, without those after a run's first period."""
    if not len(runs):
        return b" ".join(b" ".join(w) for w in slices(raw) if w)
    drop = np.zeros(n + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(drop[:n]) == 0
    out, at = [], 0
    for w in slices(raw):
        flags = keep[at:at + len(w)]
        at += len(w)
        w = [x for x, f in zip(w, flags.tolist()) if f]
        if w:
            out.append(b" ".join(w))
    return b" ".join(out)


def _batch(min_exponent: int, min_length: int):
    def chunk(raws: list[bytes]) -> list[tuple[int, np.ndarray, bytes]]:
        ids = [word_ids(r) for r in raws]
        size = [len(x) for x in ids]
        # a name of its own after every text, so that no run crosses a border
        borders = splitmix(np.arange(1, len(ids) + 1, dtype=np.uint64) * U(0xD6E8FEB86659FD93)).view(np.int64)
        t = np.concatenate([x for i, a in enumerate(ids) for x in (a, borders[i:i + 1])])
        rows = find_runs(t, max(size), min_exponent, min_length)
        first = np.cumsum([0] + [s + 1 for s in size])
        cut = np.searchsorted(rows[:, 0], first)
        out = []
        for i, raw in enumerate(raws):
            own = rows[cut[i]:cut[i + 1]] - np.array([first[i], 0, 0])
            out.append((size[i], own, _kept_words(raw, size[i], own)))
        return out

    def run(batches):
        for b in batches:
            text = b.column("text")
            lo = 0
            while lo < b.num_rows:
                raws, held, at = [], 0, lo
                while at < b.num_rows and (not raws or held < CHUNK_WORDS * 6):
                    raws.append((text[at].as_py() or "").encode())
                    held += len(raws[-1])
                    at += 1
                got = chunk(raws)
                counts = np.cumsum([0] + [len(r) for _, r, _ in got])
                flat = np.concatenate([r for _, r, _ in got])
                runs = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, c], pa.int64()) for c in range(3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, at - lo), pa.array([n for n, _, _ in got], pa.int64()), runs,
                     pa.array([k for _, _, k in got], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                lo = at
    return run


def periodic_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row:
    its words without those that repeat a run's first period. One map-only pass."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(
        _batch(min_exponent, min_length),
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
