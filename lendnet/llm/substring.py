"""Substring dedup: repeated-phrase automata.

A window is 13 consecutive words of one document; a word goes if a window over it also starts in a
document with a smaller doc_id.

1. Documents are packed, in a map-only pass, into stored blocks of about 1 MB of text (compressed, one row a
   block). A block is the unit of every later step, so no step holds more than a block and its answers.
2. Confirm recurring windows: each block sends its distinct 64-bit window hashes with the smallest id
   that has them, cut into buckets by hash range (one compressed row per block and bucket). A bucket
   finds each window's smallest document and answers every other block that has the window. A window found in
   a third of all documents is one entry a block, not one a document.
3. Compile and stream: a block's recurring passages (runs of windows with one owner bound) become a shard of
   the phrase set, an Aho-Corasick automaton over word numbers; all documents of the block stream
   through it, and every occurrence in a document above the owner bound marks its words.

Equal hashes stand for equal windows: with N distinct windows the expected number of false pairs is
N * N / 2**65 (0.0004 at 125 million windows); the automaton itself matches whole word sequences.

Cases: null or empty text has no words, and the digest of the empty string; texts below 13 words lose nothing;
rows that repeat a doc_id do not remove each other (neither id is smaller); rows with a null doc_id
neither remove nor lose words; an empty table gives an empty result; extra columns are not read. doc_id
must be an integer type.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import ship, stored
from lendnet.llm.words import raw_words, row_windows, text_buffer

WINDOW = 13
BLOCK_BYTES = 1 << 20
BUCKET_WINDOWS = 1_000_000
U = np.uint64
NONE = np.iinfo(np.int64).max      # stands for a null doc_id: larger than any real id, and never compared


def _zip(raw: bytes, level: int = 1) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=level).compress(raw)


def _unzip(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(raw)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of an integer array, all first bytes before all second bytes: compresses far better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplanes(raw: bytes, dtype, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T).reshape(-1).view(dtype)


def _pack_sorted(h: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit values as byte planes of their differences."""
    return _planes(np.diff(h, prepend=U(0)))


def _unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unplanes(raw, np.uint64, n), dtype=np.uint64)


# ---- blocks --------------------------------------------------------------------------------------

def _block_rows(block_bytes: int):
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, sizes, parts, held = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([held], pa.int64()),
                 pa.array([_zip(b"".join(parts), 6)], pa.binary())],
                names=["block", "doc_ids", "sizes", "n_bytes", "texts"])
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            for i, key in enumerate(b.column("doc_id").to_pylist()):
                ids.append(key)
                sizes.append(int(offsets[i + 1] - offsets[i]))
                parts.append(raw[offsets[i]:offsets[i + 1]].tobytes())
                held += sizes[-1]
                if held >= block_bytes:
                    yield flush()
                    seq += 1
                    ids, sizes, parts, held = [], [], [], 0
        if ids:
            yield flush()
    return run


class _Block:
    """Words and windows of one block's documents."""

    def __init__(self, doc_ids, sizes, texts: bytes, size: int):
        self.given = list(doc_ids)
        self.ids = np.array([NONE if x is None or x != x else int(x) for x in doc_ids], np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)
        raw = np.frombuffer(_unzip(texts), np.uint8)
        self.offsets = offsets
        self.w = next(raw_words(raw, offsets, limit=max(len(raw), 1)))
        if self.w.hi < len(self.given):      # trailing empty texts belong to the block too
            self.w = self.w._replace(hi=len(self.given), first=np.append(
                self.w.first, np.full(len(self.given) - self.w.hi, self.w.first[-1])))
        self.hash = self.w.hashes()
        self.row = np.repeat(np.arange(len(self.given)), np.diff(self.w.first))
        self.at, win = row_windows(self.hash, self.w.first, size)
        known = self.ids[self.row[self.at]] != NONE if len(self.at) else np.zeros(0, bool)
        self.at, win = self.at[known], win[known]
        order = np.argsort(win, kind="stable")
        new = np.ones(len(win), bool)
        new[1:] = win[order][1:] != win[order][:-1]
        self.distinct = win[order][new]                      # sorted distinct windows
        self.number = np.empty(len(win), np.int64)           # window -> index in distinct
        self.number[order] = np.cumsum(new) - 1
        doc = self.ids[self.row[self.at]] if len(win) else np.zeros(0, np.int64)
        self.doc = doc
        self.least = (np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(win) else doc)


def _window_rows(size: int, buckets: int):
    edges = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                x = _Block(*(b.column(c)[i].as_py() for c in ("doc_ids", "sizes", "texts")), size)
                cut = np.concatenate([[0], np.searchsorted(x.distinct, edges), [len(x.distinct)]])
                out = []
                for k in np.flatnonzero(np.diff(cut)):
                    h, d = x.distinct[cut[k]:cut[k + 1]], x.least[cut[k]:cut[k + 1]]
                    docs, which = np.unique(d, return_inverse=True)
                    raw = _pack_sorted(h) + _planes(which.astype(np.uint32)) + _planes(np.diff(docs, prepend=0))
                    out.append((int(k), b.column("block")[i].as_py(), len(h), len(docs), _zip(raw)))
                cols = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["bucket", "block", "n", "n_docs", "entries"])
    return run


def _answer_bucket(pdf):
    """For one hash range: to every block, its windows that start in a smaller document elsewhere."""
    import pandas as pd
    hs, ds = [], []
    for n, nd, z in zip(pdf["n"], pdf["n_docs"], pdf["entries"]):
        raw = _unzip(z)
        docs = np.cumsum(_unplanes(raw[12 * n:], np.int64, nd))
        hs.append(_unpack_sorted(raw, n))
        ds.append(docs[_unplanes(raw[8 * n:], np.uint32, n)])
    h, d = np.concatenate(hs), np.concatenate(ds)
    sizes = pdf["n"].to_numpy()
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    least = np.minimum.reduceat(d[order], np.flatnonzero(new))
    beaten = np.empty(len(h), bool)
    beaten[order] = d[order] > least[np.cumsum(new) - 1]
    ends = np.cumsum(sizes)
    rows = []
    for block, lo, hi in zip(pdf["block"], ends - sizes, ends):
        out = h[lo:hi][beaten[lo:hi]]
        if len(out):
            rows.append((block, len(out), _zip(_pack_sorted(out))))
    return pd.DataFrame(rows, columns=["block", "n", "beaten"])


def _cut_block(size: int):
    def run(left, right):
        import ahocorasick
        import pandas as pd
        if not len(left):
            return pd.DataFrame({"doc_id": pd.Series([], dtype="Int64"), "n_words": pd.Series([], dtype="int64"),
                                 "n_removed": pd.Series([], dtype="int64"), "kept_sha256": pd.Series([], dtype=str)})
        r = left.iloc[0]
        x = _Block(r["doc_ids"], r["sizes"], r["texts"], size)
        answers = [_unpack_sorted(_unzip(z), n) for n, z in zip(right["n"], right["beaten"])]
        bound = x.least.copy()               # a document above its window's bound loses the window
        if answers:
            bound[np.isin(x.distinct, np.concatenate(answers), assume_unique=True)] = np.iinfo(np.int64).min
        limit = bound[x.number]
        gone = np.flatnonzero(x.doc > limit)
        n = len(x.hash)
        marks = np.zeros(n + 1, np.int64)
        if len(gone):
            at, lim = x.at[gone], limit[gone]
            brk = np.ones(len(gone), bool)
            brk[1:] = (at[1:] != at[:-1] + 1) | (lim[1:] != lim[:-1]) | (x.row[at[1:]] != x.row[at[:-1]])
            lo = np.flatnonzero(brk)
            hi = np.append(lo[1:], len(gone)) - 1
            numbers = np.unique(x.hash, return_inverse=True)[1].tolist()
            shard = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for a, z in zip(lo, hi):
                phrase = tuple(numbers[at[a]:at[z] + size])
                shard.add_word(phrase, (len(phrase), int(lim[a])))
            shard.make_automaton()
            for d in range(len(x.given)):
                a, z = int(x.w.first[d]), int(x.w.first[d + 1])
                own = int(x.ids[d])
                if own == NONE or z - a < size:
                    continue
                for end, (length, owner) in shard.iter(tuple(numbers[a:z])):
                    if own > owner:
                        marks[a + end - length + 1] += 1
                        marks[a + end + 1] -= 1
        kept = np.cumsum(marks[:-1]) == 0
        words_before = np.concatenate([[0], np.cumsum(kept)])
        # bytes of the kept words, each with the separator that follows it written as a blank
        size_b = len(x.w.buf)
        step = np.zeros(size_b + 2, np.int32)
        text_end = x.offsets[1:][x.row] if n else np.zeros(0, np.int64)
        stop = np.minimum(x.w.ends + 1, text_end)
        np.add.at(step, x.w.starts[kept], 1)
        np.add.at(step, stop[kept], -1)
        take = np.cumsum(step[:size_b]) > 0
        buf = x.w.buf.copy()
        after = x.w.ends[kept & (x.w.ends < text_end)] if n else np.zeros(0, np.int64)
        buf[after] = 32
        before = np.concatenate([[0], np.cumsum(take)])
        data = buf[take].tobytes()
        sha, count, removed = [], [], []
        for d in range(len(x.given)):
            a, z = x.w.first[d], x.w.first[d + 1]
            part = data[before[x.offsets[d]]:before[x.offsets[d + 1]]]
            sha.append(hashlib.sha256(part[:-1] if part.endswith(b" ") else part).hexdigest())
            count.append(int(z - a))
            removed.append(int(z - a - (words_before[z] - words_before[a])))
        ids = pd.array([None if v == NONE else int(v) for v in x.ids], dtype="Int64")
        return pd.DataFrame({"doc_id": ids, "n_words": count, "n_removed": removed, "kept_sha256": sha})
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    ship(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(src.mapInArrow(
        _block_rows(block_bytes), "block long, doc_ids array<long>, sizes array<long>, n_bytes long, texts binary"),
        "blocks", compression="none")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-int(total) // (6 * BUCKET_WINDOWS)))     # about 6 bytes a word
    sent = blocks.select("block", "doc_ids", "sizes", "texts").mapInArrow(
        _window_rows(window, buckets), "bucket int, block long, n int, n_docs int, entries binary")
    answers = sent.groupBy("bucket").applyInPandas(_answer_bucket, "block long, n int, beaten binary")
    return (blocks.select("block", "doc_ids", "sizes", "texts").groupBy("block")
            .cogroup(answers.groupBy("block"))
            .applyInPandas(_cut_block(window), "doc_id long, n_words long, n_removed long, kept_sha256 string"))
