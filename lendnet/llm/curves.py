"""Approximate nearest neighbours: shifted space-filling curves.

Every vector is projected on ``DIMS`` random orthonormal directions, once per curve, shifted by a random vector and
numbered along a Hilbert curve. A curve's order is cut into ranges of equal numbers of rows; a query meets the rows
of its own range and of the ``REACH`` ranges on either side, on every curve, and keeps its nearest by the distance
of the original vectors. The curves' lists are then merged.

The window's width decides what is found. It is fitted on ``CALIBRATION`` rows (chosen by a hash of the row): their
true neighbours come from one pass over all rows, and a window reaches at least as far as the distance along the
best curve that covers ``TARGET`` of them. Scale, splitters and width are the index's parameters, fitted on bounded samples
(``FIT_ROWS`` vectors, ``KEY_ROWS`` curve positions); every row is indexed. Where neighbours lie close (clusters,
copies) ranges are narrow and work grows with the rows; where the vectors have no structure the width becomes a
share of the table, as every method of this kind then has to read such a share.

Hot spots: of rows with one vector only the k + 1 smallest ids can be among k nearest, so the others are not
candidates (they still are queries). A range that holds more than ``GROUP_ROWS`` rows is dealt over several groups
by a hash of the row, its queries to each of them; many queries of a range are dealt likewise.

Cases: vectors that are null, zero, of another length than the table's most frequent one (ties: the longer), or
with null or non-finite components take no part, nor do null ids; a repeated id is one vector set: its distance is
that of its nearest row, and an id is never its own neighbour; equal distances go to the smaller id; fewer
candidates than k give fewer rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.llm.common import ship

DIMS = 8
BITS = 7
CURVES = 3
TARGET = 0.96
CALIBRATION = 192
FIT_ROWS = 4096            # or fewer: at most 2**22 components
KEY_ROWS = 1 << 15
REACH = 4                  # ranges on either side of a query's own
MIN_RANGE = 256            # rows of a range at least
MAX_RANGES = 1 << 16       # ranges of a curve at most: what the splitters' broadcast may hold
GROUP_ROWS = 1 << 16       # rows (or queries) of one group at most
BROADCAST_ROWS = 100_000   # shared vectors (16 bytes each) that are broadcast; beyond, a shuffled join
BLOCK = 64                 # queries scored at once against a group


class Index(NamedTuple):
    base: np.ndarray       # curves x length x dims: projections
    low: np.ndarray        # curves x dims: start of the used half of the cube
    span: np.ndarray       # curves: its width
    shift: np.ndarray      # curves x dims: shifts inside the cube (0 .. 0.5)
    splits: list           # per curve: first positions of the ranges after the first

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Positions of the vectors on every curve (n x curves)."""
        out = []
        for base, low, span, shift in zip(self.base, self.low, self.span, self.shift):
            cells = ((x @ base - low) / span * 0.5 + shift) * (1 << BITS)
            out.append(hilbert(np.clip(np.floor(cells), 0, (1 << BITS) - 1).astype(np.int64)))
        return np.stack(out, axis=1)

    def ranges(self, x: np.ndarray) -> np.ndarray:
        """Range numbers of the vectors on every curve (n x curves)."""
        k = self.keys(x)
        return np.stack([np.searchsorted(s, k[:, c], side="right") for c, s in enumerate(self.splits)], axis=1)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions along the Hilbert curve of integer cells (n x dims, ``bits`` bits each)."""
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:                               # undo the curve's reflections and exchanges, from the top bit
        low = q - 1
        for d in range(len(x)):
            on = (x[d] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
        q >>= 1
    for d in range(1, len(x)):                 # Gray code
        x[d] ^= x[d - 1]
    flip = np.zeros(len(cells), np.int64)
    q = top
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << 1) | (((x[d] ^ flip) >> b) & 1)
    return key


def _matrix(col: pa.Array, length: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def _squares(q: np.ndarray, x: np.ndarray, xx: np.ndarray) -> np.ndarray:
    return (q * q).sum(axis=1)[:, None] + xx - 2 * (q @ x.T)


def _nearest(q: np.ndarray, own, x: np.ndarray, ids: np.ndarray, k: int):
    """(query number, row number, distance) of the k nearest rows with different ids, for each query."""
    xx = (x * x).sum(axis=1)
    often = int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 1
    enough = (k - 1) * often + 1           # so many rows hold k different ids
    out_q, out_x, out_d = [], [], []
    for at in range(0, len(q), BLOCK):
        part = q[at:at + BLOCK]
        d = _squares(part, x, xx)
        d[own[at:at + BLOCK, None] == ids] = np.inf
        # the expanded squares only choose whom to measure; the margin covers their rounding
        margin = 1e-9 * ((part * part).sum(axis=1) + (xx.max() if len(xx) else 0))
        if enough < len(x):
            bound = np.partition(d, enough - 1, axis=1)[:, enough - 1] + margin
        else:
            bound = np.full(len(part), np.inf)
        bound = np.minimum(bound, np.finfo(np.float64).max)       # a query's own rows stand at infinity
        for i in range(len(part)):
            near = np.flatnonzero(d[i] <= bound[i])
            exact = np.sqrt(((x[near] - part[i]) ** 2).sum(axis=1))
            order = np.lexsort((ids[near], exact))
            if often > 1:
                order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])]
            order = order[:k]
            out_q.append(np.full(len(order), at + i))
            out_x.append(near[order])
            out_d.append(exact[order])
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_d)


def _calibrate(ref, k: int):
    def run(batches):
        index, q, own = ref.value
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, len(index.base)), np.int64))] * len(q)
        for b in batches:
            x, ids = _matrix(b.column("v"), q.shape[1]), b.column("vec_id").to_numpy()
            qi, xi, d = _nearest(q, own, x, ids, k)
            keys = index.keys(x[xi])
            cut = np.searchsorted(qi, np.arange(len(q) + 1))
            for i in range(len(q)):
                s = slice(cut[i], cut[i + 1])
                merged = [np.concatenate([old, new]) for old, new in zip(best[i], (d[s], ids[xi[s]], keys[s]))]
                order = np.lexsort((merged[1], merged[0]))[:k]
                best[i] = tuple(m[order] for m in merged)
        n = [len(x[0]) for x in best]
        d, ids, keys = (np.concatenate([x[c] for x in best]) for c in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(q)), n)), pa.array(d), pa.array(ids),
             pa.array(keys.tolist(), pa.list_(pa.int64()))], names=["q", "d", "vec_id", "keys"])
    return run


def _count(ref, length: int):
    """Rows and queries of every range that a task sees."""
    def run(batches):
        index = ref.value
        n = [np.zeros((2, len(s) + 1), np.int64) for s in index.splits]
        for b in batches:
            r = index.ranges(_matrix(b.column("v"), length))
            asks = b.column("is_query").to_numpy(zero_copy_only=False)
            for c, total in enumerate(n):
                for side in (0, 1):
                    np.add.at(total[side], r[asks == side, c], 1)
        rows = [(c, i, int(t[0, i]), int(t[1, i])) for c, t in enumerate(n) for i in np.flatnonzero(t.sum(axis=0)).tolist()]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                         names=["curve", "range", "n_rows", "n_queries"])
    return run


def _deal(ref, length: int):
    """Copies of rows to their range, of queries to their window's ranges, on every curve."""
    def run(batches):
        index, row_parts, query_parts = ref.value
        for b in batches:
            r = index.ranges(_matrix(b.column("v"), length))
            asks = b.column("is_query").to_numpy(zero_copy_only=False)
            draw = b.column("draw").to_numpy()
            out = []                                  # (row of the batch, curve, range, row part, query part)
            for c, splits in enumerate(index.splits):
                for side, steps in ((False, (0,)), (True, range(-REACH, REACH + 1))):
                    own = np.flatnonzero(asks == side)
                    for step in steps:
                        at = r[own, c] + step
                        ok = (at >= 0) & (at <= len(splits))
                        i, at = own[ok], at[ok]
                        # a row lies in one row part and meets all query parts; a query the other way round
                        fixed, other = (query_parts, row_parts) if side else (row_parts, query_parts)
                        mine = draw[i] % fixed[c][at]
                        times = other[c][at]
                        i, at, mine = (np.repeat(x, times) for x in (i, at, mine))
                        all_of = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                        pair = (all_of, mine) if side else (mine, all_of)
                        out.append(np.stack([i, np.full(len(i), c), at, *pair]))
            rows = np.concatenate(out, axis=1)
            for lo in range(0, rows.shape[1], 1 << 14):
                part = rows[:, lo:lo + (1 << 14)]
                take = pa.array(part[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[1], pa.int32()), pa.array(part[2], pa.int32()), pa.array(part[3], pa.int32()),
                     pa.array(part[4], pa.int32()), *(b.column(n).take(take) for n in ("is_query", "vec_id", "v"))],
                    names=["curve", "range", "row_part", "query_part", "is_query", "vec_id", "v"])
    return run


def _window(k: int, length: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("is_query").to_numpy()
        ids, v = group.column("vec_id").to_numpy(), _matrix(group.column("v").combine_chunks(), length)
        x, q = np.flatnonzero(~asks), np.flatnonzero(asks)
        qi, xi, d = _nearest(v[q], ids[q], v[x], ids[x], k)
        return pa.table({"query_id": ids[q][qi], "vec_id": ids[x][xi], "score": d})
    return run


def _usable(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """(vec_id, v, h1, h2), the vectors' length and the number of rows that take part."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    v = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        "vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND abs(x) < double('infinity')) "
        "AND exists(v, x -> x <> 0)")
    sizes = src.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("length")).first()
    if top is None:
        return src, 0, 0
    src = src.filter(F.size("v") == top["length"])
    # two hashes with seeds of their own stand for the vector
    return src.select("vec_id", "v", F.xxhash64(F.lit(1), "v").alias("h1"),
                      F.xxhash64(F.lit(2), "v").alias("h2")), top["length"], top["n"]


def _candidates(src: DataFrame, k: int) -> DataFrame:
    """``src`` with only the k + 1 smallest ids of each vector that more than k + 1 rows share."""
    crowded = src.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k + 1).select("h1", "h2")
    crowded = crowded.checkpoint()
    n = crowded.count()
    if n == 0:
        return src
    side = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
    inside = src.join(side, ["h1", "h2"], "left_semi")
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    small = (inside.select("h1", "h2", "vec_id").distinct().withColumn("_r", F.row_number().over(order))
             .filter(F.col("_r") <= k + 1).drop("_r"))
    vector = inside.groupBy("h1", "h2").agg(F.first("v").alias("v"))
    rows = small.join(vector, ["h1", "h2"]).select("vec_id", "v", "h1", "h2")
    return src.join(side, ["h1", "h2"], "left_anti").select("vec_id", "v", "h1", "h2").unionByName(rows)


def fit(src: DataFrame, candidates: DataFrame, length: int, n: int, k: int, seed: int = 7) -> tuple[Index, float]:
    """The index of ``candidates`` and the window's reach (share of the rows)."""
    spark = src.sparkSession

    def sample(rows: int, salt: int) -> DataFrame:
        draw = F.pmod(F.xxhash64(F.lit(salt), "vec_id", "h1"), F.lit(1 << 30)) / float(1 << 30)
        return src.filter(draw < min(1.0, rows / n))

    rng = np.random.default_rng(seed)
    dims = min(DIMS, length)
    base = np.stack([np.linalg.qr(rng.normal(size=(length, dims)))[0] for _ in range(CURVES)])
    shift = rng.random((CURVES, dims)) * 0.5
    fit_rows = sample(min(FIT_ROWS, max(64, (1 << 22) // length)), 3).select("v").toArrow()
    x = _matrix(fit_rows.column("v").combine_chunks(), length) if fit_rows.num_rows else np.zeros((1, length))
    y = np.stack([x @ b for b in base])
    low, high = np.quantile(y, 0.005, axis=1), np.quantile(y, 0.995, axis=1)
    span = np.maximum((high - low).max(axis=1), 1e-12)
    index = Index(base, low, span, shift, [np.zeros(0, np.int64)] * CURVES)

    ref = spark.sparkContext.broadcast(index)

    def positions(batches):
        for b in batches:
            keys = ref.value.keys(_matrix(b.column("v"), length))
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, c]) for c in range(CURVES)],
                                             names=[f"k{c}" for c in range(CURVES)])
    got = sample(KEY_ROWS, 4).select("v").mapInArrow(positions, ", ".join(f"k{c} long" for c in range(CURVES))).toArrow()
    known = [np.sort(got.column(f"k{c}").to_numpy()) for c in range(CURVES)]
    if not len(known[0]):
        return index, 1.0
    asked = sample(CALIBRATION, 5).select("vec_id", "v").toArrow()
    if asked.num_rows == 0:
        return index, 1.0
    q = _matrix(asked.column("v").combine_chunks(), length)
    probe = spark.sparkContext.broadcast((index, q, asked.column("vec_id").to_numpy()))
    near = candidates.select("vec_id", "v").mapInArrow(
        _calibrate(probe, k), "q long, d double, vec_id long, keys array<long>")
    order = Window.partitionBy("q").orderBy("d", "vec_id")
    near = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("q", "keys").toArrow()
    if near.num_rows == 0:
        return index, 1.0

    def share(keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(known[c], keys[:, c]) for c in range(CURVES)], axis=1) / len(known[0])
    there = share(np.array(near.column("keys").to_pylist(), np.int64).reshape(-1, CURVES))
    here = share(index.keys(q))[near.column("q").to_numpy()]
    width = float(np.quantile(np.abs(here - there).min(axis=1), TARGET))
    count = int(max(1, min(MAX_RANGES, n // MIN_RANGE, REACH / max(width, 1e-9))))
    splits = [s[(np.arange(1, count) * len(s)) // count] for s in known]
    return index._replace(splits=splits), width


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean) of the ``k`` nearest found for each row whose id ``every`` divides."""
    spark = vectors.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    src, length, n = _usable(vectors)
    if n == 0:
        return empty
    candidates = _candidates(src, k)
    index, _ = fit(src, candidates, length, n, k)
    draw = F.pmod(F.xxhash64(F.lit(6), "vec_id", "h1"), F.lit(1 << 40))
    queries = (src.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "h1", "h2").agg(F.first("v").alias("v")))
    both = candidates.select("vec_id", "v", draw.alias("draw"), F.lit(False).alias("is_query")).unionByName(
        queries.select("vec_id", "v", draw.alias("draw"), F.lit(True).alias("is_query")))
    counts = (both.mapInArrow(_count(spark.sparkContext.broadcast(index), length),
                              "curve int, `range` int, n_rows long, n_queries long")
              .groupBy("curve", "range").agg(F.sum("n_rows").alias("x"), F.sum("n_queries").alias("q")).toArrow())
    rows, asks = ([np.zeros(len(s) + 1, np.int64) for s in index.splits] for _ in range(2))
    for c, r, x, q in zip(*(counts.column(i).to_pylist() for i in range(4))):
        rows[c][r], asks[c][r] = x, q
    windows = [np.convolve(a, np.ones(2 * REACH + 1, np.int64))[REACH:REACH + len(a)] for a in asks]
    parts = [[np.maximum(1, -(-x // GROUP_ROWS)) for x in side] for side in (rows, windows)]
    kind = src.schema["v"].dataType.simpleString()
    dealt = both.mapInArrow(
        _deal(spark.sparkContext.broadcast((index, *parts)), length),
        f"curve int, `range` int, row_part int, query_part int, is_query boolean, vec_id long, v {kind}")
    found = dealt.groupBy("curve", "range", "row_part", "query_part").applyInArrow(
        _window(k, length), "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
