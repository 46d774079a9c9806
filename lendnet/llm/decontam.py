"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

The benchmark is taken in parts of at most ``PART_WORDS`` words, so what a part broadcasts (its items'
word hashes and their 3-word grams) is bounded whatever the benchmark's size; more parts mean more passes.
For each part, one pass counts in how many documents each gram occurs; an item's seeds are its grams
that occur in at most four times as many documents as its median gram, plus 32, and the rarest of every three
grams in a row: any five words of an item hold a seed, also where only that passage has copies everywhere.
A second pass finds the seeds in all documents, opens a window around each diagonal they lie on and aligns item
and window (match 1, mismatch and gap -0.5); what an alignment leaves on either side is aligned again.

A document holds an item where one alignment scores ``PASSAGE_WORDS`` (13 words in a row, or more with edits), or
where alignments that follow each other in item and text, each of ``PART_SCORE`` or more, add up to ``least_score``
of the item's length. The score is that sum over the length: 1 for a copy, whole or broken by inserted text, about
0.7 where a fifth of the words were edited, 0.42 for 25 words of 59.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; punctuation separates.

Cases: null or empty texts match nothing, on either side; items shorter than a gram use their whole text as
one seed; repeated rows are reported row by row; a window is as long as twice its item, so very long
texts only add windows; extra columns are not read, and ``decontaminate`` keeps all columns of its input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import release_memory, ship
from lendnet.llm.words import PUNCT, row_windows, windows, words

GRAM = 3
LEAST_SCORE = 0.5
PART_WORDS = 2_000_000
PASSAGE_WORDS = 13           # an alignment of this score is a passage, whatever its share of the item
PART_SCORE = 5               # alignments from this score on are added up
GAP = 0.5
U = np.uint64
MASK_BITS = 20


def _word_hashes(batch_col: pa.Array):
    for w in words(batch_col, lower=True, separators=PUNCT):
        yield w, w.hashes()


def _item_rows(batches):
    for b in batches:
        keep, seqs = [], []
        for w, h in _word_hashes(b.column("text")):
            for r in range(w.hi - w.lo):
                if w.first[r + 1] > w.first[r]:
                    keep.append(w.lo + r)
                    seqs.append(h[w.first[r]:w.first[r + 1]].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column("item_id").take(pa.array(keep, pa.int64())), pa.array(seqs, pa.list_(pa.int64()))],
            names=["item_id", "words"])


def benchmark_parts(benchmark: DataFrame, part_words: int = PART_WORDS):
    """Lists of (item_id, word hashes), each list of about ``part_words`` words at most."""
    ship(benchmark.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").mapInArrow(
        _item_rows, f"item_id {kind}, words array<long>").persist()
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = -(-int(total) // part_words)
    for i in range(parts):
        rows = items.filter(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(parts)) == i).collect()
        yield sorted(((r["item_id"], np.array(r["words"], np.int64).view(np.uint64)) for r in rows),
                     key=lambda x: (str(x[0]), x[1].tobytes()))
    items.unpersist()


def _item_grams(seq: np.ndarray) -> np.ndarray:
    return windows(seq, min(GRAM, len(seq)))


def _lookup(sorted_keys: np.ndarray):
    """Membership test of 64-bit hashes in a small sorted table: (positions, indices) of the hits."""
    mask = np.zeros(1 << MASK_BITS, bool)
    mask[(sorted_keys & U((1 << MASK_BITS) - 1)).astype(np.int64)] = True

    def find(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(mask[(h & U((1 << MASK_BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(sorted_keys):
            return at[:0], at[:0]
        i = np.minimum(np.searchsorted(sorted_keys, h[at]), len(sorted_keys) - 1)
        ok = sorted_keys[i] == h[at]
        return at[ok], i[ok]
    return find


def _text_grams(w, h: np.ndarray, sizes):
    """(gram start, gram hash) for every gram length in use."""
    for k in sizes:
        yield row_windows(h, w.first, k)


def _count_batches(ref):
    def run(batches):
        release_memory()
        keys, sizes = ref.value
        find = _lookup(keys)
        df = np.zeros(len(keys), np.int64)
        for b in batches:
            for w, h in _word_hashes(b.column("text")):
                rows = w.rows()
                for at, g in _text_grams(w, h, sizes):
                    p, i = find(g)
                    pair = np.unique(rows[at[p]] * len(keys) + i) if len(p) else p
                    df += np.bincount(pair % max(len(keys), 1), minlength=len(keys))
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(df[i])], names=["gram", "n"])
    return run


def _rarest_of_run(freq: np.ndarray, run: int = PART_SCORE - GRAM + 1) -> np.ndarray:
    """True for grams that no other gram of some ``run`` grams in a row is rarer than."""
    out = np.zeros(len(freq), bool)
    for at in range(len(freq) - run + 1):
        part = freq[at:at + run]
        out[at:at + run] |= part == part.min()
    return out


def _rare_seeds(docs: DataFrame, items) -> dict:
    """Sorted seed hashes of a part with their postings (item number, position in the item)."""
    spark = docs.sparkSession
    grams = [_item_grams(seq) for _, seq in items]
    sizes = sorted({min(GRAM, len(seq)) for _, seq in items})
    keys = np.unique(np.concatenate(grams))
    ref = spark.sparkContext.broadcast((keys, sizes))
    counted = docs.select("text").mapInArrow(_count_batches(ref), "gram long, n long").groupBy("gram").agg(
        F.sum("n").alias("n")).collect()
    df = np.zeros(len(keys), np.int64)
    for r in counted:
        df[r["gram"]] = r["n"]
    seed, item, pos = [], [], []
    for n, g in enumerate(grams):
        freq = df[np.searchsorted(keys, g)]
        rare = np.flatnonzero((freq <= 4 * np.sort(freq)[(len(g) - 1) // 2] + 32) | _rarest_of_run(freq))
        seed.append(g[rare])
        item.append(np.full(len(rare), n))
        pos.append(rare)
    seed, item, pos = np.concatenate(seed), np.concatenate(item), np.concatenate(pos)
    order = np.argsort(seed, kind="stable")
    seed, item, pos = seed[order], item[order], pos[order]
    table, first = np.unique(seed, return_index=True)
    return {"seeds": table, "first": np.append(first, len(seed)), "item": item, "pos": pos, "sizes": sizes,
            "words": [seq for _, seq in items], "ids": [i for i, _ in items]}


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """(best local alignment score, its end in the window, its end in the item) with match 1, mismatch and gap -GAP."""
    n = len(window)
    ramp = GAP * np.arange(n + 1)
    row = np.zeros(n + 1)
    best, end, item_end = 0.0, 0, 0
    for i, x in enumerate(item, 1):
        cand = np.maximum(row, 0.0)
        cand[1:] = np.maximum(np.maximum(row[:-1] + np.where(window == x, 1.0, -GAP), row[1:] - GAP), 0.0)
        cand[0] = 0.0
        # gaps along the window: the best earlier cell less the distance
        row = np.maximum.accumulate(cand + ramp) - ramp
        j = int(row.argmax())
        if row[j] > best:
            best, end, item_end = float(row[j]), j, i
    return best, end, item_end


def _segments(seq: np.ndarray, window: np.ndarray, least: float):
    """(item start, item end, start, end, score) of the best alignment, then of the best ones before and after it."""
    todo = [(0, len(seq), 0, len(window))]
    while todo:
        i, k, a, z = todo.pop()
        if min(k - i, z - a) < least:
            continue
        score, end, item_end = align(seq[i:k], window[a:z])
        if score < least:
            continue
        # read backwards from its end, the alignment ends at its start
        _, back, item_back = align(seq[i:i + item_end][::-1], window[a:a + end][::-1])
        cut = (i + item_end - item_back, i + item_end, a + end - back, a + end)
        yield (*cut, score)
        todo += [(i, cut[0], a, cut[2]), (cut[1], k, cut[3], z)]


def _best_chain(parts: np.ndarray) -> tuple[float, int, int]:
    """(score, start, end) of the best sum of segments that follow each other in item and text."""
    parts = parts[np.lexsort((parts[:, 2], parts[:, 0]))]
    total, start = parts[:, 4].copy(), parts[:, 2].copy()
    for t in range(1, len(parts)):
        before = np.flatnonzero((parts[:t, 1] <= parts[t, 0]) & (parts[:t, 3] <= parts[t, 2]))
        if len(before):
            b = before[total[before].argmax()]
            total[t] += total[b]
            start[t] = start[b]
    t = int(total.argmax())
    return float(total[t]), int(start[t]), int(parts[t, 3])


def _doc_matches(m, h: np.ndarray, starts: np.ndarray, seeds: np.ndarray, least: float):
    """(item number, score, start word, end word) of the best passage of each item in one text."""
    count = m["first"][seeds + 1] - m["first"][seeds]
    post = np.repeat(m["first"][seeds] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    item, pos = m["item"][post], m["pos"][post]
    diag = np.repeat(starts, count) - pos
    order = np.lexsort((diag, item))
    item, pos, diag = item[order], pos[order], diag[order]
    cut = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
    for lo, hi in zip(cut, np.append(cut[1:], len(item))):
        seq = m["words"][item[lo]]
        slack, share = max(4, len(seq) // 4), least * len(seq)
        ends = np.append(lo + 1 + np.flatnonzero(np.diff(diag[lo:hi]) > slack), hi)
        spans, there = [], np.zeros(len(seq), bool)
        for x, y in zip(np.append(lo, ends[:-1]), ends):
            a, z = max(0, int(diag[x]) - slack), min(len(h), int(diag[y - 1]) + len(seq) + slack)
            known = np.isin(seq, h[a:z])
            there |= known
            spans.append((a, z, int(known.sum()), (pos[x:y] != pos[x]).any()))
        # no alignment, and no sum of them, can score more than the item's words that occur in the windows
        whole = there.sum() >= share
        parts = set()
        for a, z, known, several in spans:
            if known >= min(PART_SCORE, share) if whole else several and known >= PASSAGE_WORDS:
                least_part = min(PART_SCORE, share) if whole else PASSAGE_WORDS
                parts |= {(i, k, a + b, a + e, s) for i, k, b, e, s in _segments(seq, h[a:z], least_part)}
        if not parts:
            continue
        parts = np.array(sorted(parts), np.float64)
        score, start, end = _best_chain(parts)
        if score >= share or parts[:, 4].max() >= PASSAGE_WORDS:
            yield int(item[lo]), score / len(seq), start, end


def _match_rows(m, col: pa.Array, least: float):
    """(row, item number, score, start, end) for every match in a batch."""
    find = _lookup(m["seeds"])
    for w, h in _word_hashes(col):
        rows = w.rows()
        where, seeds = [], []
        for at, g in _text_grams(w, h, m["sizes"]):
            p, i = find(g)
            where.append(at[p])
            seeds.append(i)
        where, seeds = np.concatenate(where), np.concatenate(seeds)
        if not len(where):
            continue
        r = rows[where]
        order = np.argsort(r, kind="stable")
        where, seeds, r = where[order], seeds[order], r[order]
        cut = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        for lo, hi in zip(cut, np.append(cut[1:], len(r))):
            row = int(r[lo])
            a, z = w.first[row], w.first[row + 1]
            for x in _doc_matches(m, h[a:z], where[lo:hi] - a, seeds[lo:hi], least):
                yield (w.lo + row, *x)


def _find_batches(ref, least: float):
    def run(batches):
        release_memory()
        m = ref.value
        for b in batches:
            found = list(_match_rows(m, b.column("text"), least))
            rows = pa.array([x[0] for x in found], pa.int64())
            ids = pa.array([m["ids"][x[1]] for x in found])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), ids if len(found) else ids.cast(pa.int64()),
                 pa.array([x[2] for x in found], pa.float64()), pa.array([x[3] for x in found], pa.int64()),
                 pa.array([x[4] for x in found], pa.int64())],
                names=["doc_id", "item_id", "score", "start_word", "end_word"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE,
                  part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): each item's best passage in each document."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kinds = (docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, start_word long, end_word long"
    out = spark.createDataFrame([], schema)
    for items in benchmark_parts(benchmark, part_words):
        if items:
            ref = spark.sparkContext.broadcast(_rare_seeds(src, items))
            out = out.union(src.mapInArrow(_find_batches(ref, least_score), schema))
    return out


def _clean_batches(ref, least: float):
    def run(batches):
        release_memory()
        m = ref.value
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[x[0] for x in _match_rows(m, b.column("text"), least)]] = False
            yield b.filter(pa.array(keep))
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE,
                  part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` without the documents that hold a passage of a benchmark item (map-only)."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.withColumn("text", F.col("text").cast("string"))
    out = src
    for items in benchmark_parts(benchmark, part_words):
        if items:
            ref = spark.sparkContext.broadcast(_rare_seeds(src, items))
            out = out.mapInArrow(_clean_batches(ref, least_score), src.schema)
    return out
