"""PageRank over the directed customer network (Page et al., 1999).

Nodes are customers plus every edge endpoint; parallel edges collapse (or become weights with ``weighted=True``).
Dangling mass is spread uniformly, so ranks sum to 1.

Form: with ``u_0 = 1/N`` and ``u_(j+1) = alpha * P' u_j`` (no dangling term), the t-th iterate of the usual loop is
``r_t = u_t + sum_(j<t) c_(t-j) u_j``. The numbers ``c`` follow from the masses ``S_j = sum(u_j)`` alone, since a
step loses exactly the mass that sat on nodes without out-edges: ``D_j = S_j - S_(j+1) / alpha``. So a step needs no
number from the driver, ``STEPS`` steps form one job between reliable cuts, and the ranks are one weighted sum.

Layout: nodes are dense longs, ``BLOCK`` of them a block. A cell is a packed part of a block's out-edges (about
``CELL_EDGES`` of them; a hub's edges spread over the cells of its block by their targets), partitioned once and
kept. A step is one co-group of the cells with the vector's pieces for their block and one exchange of the pieces a
cell pushes to each target block (already summed per target); a block with several cells gets a copy in each. The
first cell of a block passes the block's vector on, so that a cut holds the vectors of its steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.graph.dense import dense_edges
from lendnet.session import cut_lineage

STEPS = 5                  # steps between reliable cuts
BLOCK = 1 << 16            # nodes of a block
CELL_EDGES = 1 << 20       # edges of a cell, about
_PIECE = "block long, cell int, kept boolean, at binary, u binary"


def _coefficients(masses: list[float], alpha: float, t: int) -> list[float]:
    """Weights of u_0 .. u_t in r_t, from the masses of u_0 .. u_t."""
    d = [masses[j] - masses[j + 1] / alpha for j in range(t)]      # mass of u_j on nodes without out-edges
    c: list[float] = []                                            # c[s - 1] = alpha * dangling(r_(s-1)) + 1 - alpha
    for s in range(1, t + 1):
        dangling = d[s - 1] + sum(c[s - 2 - j] * d[j] for j in range(s - 1))
        c.append(alpha * dangling + 1.0 - alpha)
    return [c[t - 1 - j] for j in range(t)] + [1.0]


def _pack(size: int):
    """One row for a cell's edges, by target."""
    def run(cell: pa.Table) -> pa.Table:
        src, dst, share = (cell.column(c).to_numpy() for c in ("src", "dst", "share"))
        order = np.argsort(dst, kind="stable")
        return pa.table({"block": cell.column("block")[:1], "cell": cell.column("cell")[:1],
                         "src": pa.array([(src[order] % size).astype("<i4").tobytes()], pa.binary()),
                         "dst": pa.array([dst[order].astype("<i8").tobytes()], pa.binary()),
                         "share": pa.array([share[order].tobytes()], pa.binary())})
    return run


def _vector(pieces: pa.Table, size: int) -> np.ndarray:
    """A block's vector from the pieces pushed to it."""
    out = np.zeros(size)
    for at, u, kept in zip(pieces.column("at"), pieces.column("u"), pieces.column("kept")):
        if not kept.as_py():
            out[np.frombuffer(at.as_py(), "<i4")] += np.frombuffer(u.as_py())
    return out


def _push(cells_of: dict, size: int):
    def run(cell: pa.Table, pieces: pa.Table) -> pa.Table:
        rows = []                                       # (block, cell, kept, at, u)
        u = _vector(pieces, size)
        if pieces.num_rows and pieces.column("cell")[0].as_py() == 0:
            block = pieces.column("block")[0].as_py()
            held = [x.as_py() for x, k in zip(pieces.column("u"), pieces.column("kept")) if k.as_py()]
            rows.append((block, 0, True, b"", b"".join(held) + u.tobytes()))
        for r in range(cell.num_rows):
            dst = np.frombuffer(cell.column("dst")[r].as_py(), "<i8")
            first = np.flatnonzero(np.diff(dst, prepend=-1))
            sums = np.add.reduceat(u[np.frombuffer(cell.column("src")[r].as_py(), "<i4")]
                                   * np.frombuffer(cell.column("share")[r].as_py()), first)
            to = dst[first]
            cut = np.flatnonzero(np.diff(to // size, prepend=-1))
            for lo, hi in zip(cut, np.append(cut[1:], len(to))):
                block = int(to[lo] // size)
                at, part = (to[lo:hi] % size).astype("<i4").tobytes(), sums[lo:hi].tobytes()
                rows += [(block, k, False, at, part) for k in range(cells_of.get(block, 1))]
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.table({"block": pa.array(cols[0], pa.int64()), "cell": pa.array(cols[1], pa.int32()),
                         "kept": pa.array(cols[2], pa.bool_()), "at": pa.array(cols[3], pa.binary()),
                         "u": pa.array(cols[4], pa.binary())})
    return run


def _weighted(weights: np.ndarray, size: int):
    """Per block: weighted sums of its vectors, one row of ``weights`` (sums x steps) per sum."""
    def run(rows: pa.Table) -> pa.Table:
        total = np.zeros((len(weights), size))
        for j, u in zip(rows.column("j").to_pylist(), rows.column("u")):
            v = np.frombuffer(u.as_py()).reshape(-1, size)
            n = min(len(v), weights.shape[1] - j)       # vectors behind the last weight stay out
            if n > 0:
                total += weights[:, j:j + n] @ v[:n]
        return pa.table({"block": rows.column("block")[:1], "sums": pa.array([total.tobytes()], pa.binary())})
    return run


def pagerank(customers: DataFrame, edges: DataFrame, iters: int = 20, alpha: float = 0.85,
             tol: float | None = None, weighted: bool = False, cell_edges: int = CELL_EDGES,
             size: int = BLOCK, dense: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(customer_id, pagerank) for every customer.

    ``iters`` fixes the number of power iterations; with ``tol`` the loop also stops once the L1 change falls
    below ``N * tol`` (the usual convergence test). ``size``: nodes of a block. ``dense``: nodes and edges from ``dense_edges``, where the
    caller has them already.
    """
    spark = customers.sparkSession
    nodes, e = dense_edges(customers, edges) if dense is None else dense
    total = nodes.count()
    if total == 0:
        return customers.select("customer_id", F.lit(0.0).alias("pagerank"))
    weight = F.col("n").cast("double") if weighted else F.lit(1.0)
    e = e.select("src", "dst", weight.alias("w"), F.expr(f"src div {size}").alias("block"))
    counts = e.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()       # one row per block of nodes
    many = {r["block"]: -(-r["n"] // cell_edges) for r in counts if r["n"] > cell_edges}
    cells_of = F.coalesce(F.create_map(*[F.lit(x) for kv in many.items() for x in kv])[F.col("block")], F.lit(1)) \
        if many else F.lit(1)
    share = (e.join(e.groupBy("src").agg(F.sum("w").alias("wout")), "src")
             .select("block", F.pmod(F.xxhash64("dst"), cells_of).cast("int").alias("cell"), "src", "dst",
                     (F.lit(alpha) * F.col("w") / F.col("wout")).alias("share")))
    cells = cut_lineage(share.groupBy("block", "cell").applyInArrow(
        _pack(size), "block long, cell int, src binary, dst binary, share binary"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(n, "block", "cell").persist()
    push = _push(many, size)

    def start(batches):
        for b in batches:
            rows = []
            for block in b.column(0).to_pylist():
                at = np.arange(min(size, total - block * size), dtype="<i4")
                u = np.full(len(at), 1.0 / total).tobytes()
                rows += [(block, k, False, at.tobytes(), u) for k in range(many.get(block, 1))]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()))], names=["block", "cell", "kept", "at", "u"])
    state = spark.range(-(-total // size)).mapInArrow(start, _PIECE)
    cuts, done = [], 0                                 # (first step, rows with the vectors of that and later steps)
    while True:
        batch = min(STEPS, iters + 1 - done)           # the last push only gathers u_iters
        for _ in range(batch):
            right = state.select(F.col("block").alias("b"), F.col("cell").alias("c"), *state.columns)
            state = cells.groupBy("block", "cell").cogroup(right.groupBy("b", "c")).applyInArrow(
                lambda left, right: push(left, right.drop_columns(["b", "c"])), _PIECE)
        state = cut_lineage(state)
        cuts.append((done, state.filter("kept").select("block", "u")))
        state = state.filter("NOT kept")
        done += batch
        if tol is not None:
            stop = _converged(cuts, alpha, max(done - batch, 1), done - 1, total * tol, size)
            if stop is not None:
                iters = stop
                break
        if done > iters:
            break
    weights = _coefficients(_masses(cuts, size), alpha, iters)
    sums = _vectors(cuts).groupBy("block").applyInArrow(_weighted(np.array([weights]), size), "block long, sums binary")

    def unpack(batches):
        for b in batches:
            for block, raw in zip(b.column(0).to_pylist(), b.column(1)):
                r = np.frombuffer(raw.as_py())[:max(0, min(size, total - block * size))]
                yield pa.RecordBatch.from_arrays([pa.array(block * size + np.arange(len(r))), pa.array(r)],
                                                 names=["id", "rank"])
    ranks = cut_lineage(sums.mapInArrow(unpack, "id long, rank double"))
    cells.unpersist()
    named = nodes.join(ranks, "id").select(F.col("node").alias("_n"), "rank")
    return (customers.select("customer_id").join(named, F.col("customer_id") == F.col("_n"), "left")
            .select("customer_id", F.coalesce(F.col("rank"), F.lit(0.0)).alias("pagerank")))


def _vectors(cuts: list) -> DataFrame:
    """(block, j, u): the vectors of steps j, j + 1, ... of every block."""
    out = None
    for first, rows in cuts:
        part = rows.select("block", F.lit(first).alias("j"), "u")
        out = part if out is None else out.unionByName(part)
    return out


def _masses(cuts: list, size: int) -> list[float]:
    """S_0, S_1, ... from the stored vectors; the driver gets one row per step."""
    def run(batches):
        for b in batches:
            for j, u in zip(b.column("j").to_pylist(), b.column("u")):
                m = np.frombuffer(u.as_py()).reshape(-1, size).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(j + np.arange(len(m))), pa.array(m)], names=["j", "mass"])
    rows = _vectors(cuts).mapInArrow(run, "j long, mass double").groupBy("j").agg(F.sum("mass").alias("mass")).collect()
    known = {r["j"]: r["mass"] for r in rows}
    return [known.get(j, 0.0) for j in range(max(known, default=-1) + 1)]


def _converged(cuts: list, alpha: float, lo: int, hi: int, bound: float, size: int) -> int | None:
    """First t in lo .. hi whose iterate moved by less than ``bound`` in L1; two jobs for all of them."""
    masses = _masses(cuts, size)
    masses += [0.0] * (hi + 1 - len(masses))
    r = np.zeros((hi - lo + 2, hi + 1))
    for i, t in enumerate(range(lo - 1, hi + 1)):
        r[i, :t + 1] = _coefficients(masses, alpha, t)
    moves = np.diff(r, axis=0)

    def moved(batches):
        for b in batches:
            for raw in b.column("sums"):
                m = np.abs(np.frombuffer(raw.as_py()).reshape(len(moves), -1)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(m))), pa.array(m)], names=["i", "l1"])
    rows = (_vectors(cuts).groupBy("block").applyInArrow(_weighted(moves, size), "block long, sums binary")
            .mapInArrow(moved, "i long, l1 double").groupBy("i").agg(F.sum("l1").alias("l1")).collect())
    small = sorted(r["i"] for r in rows if r["l1"] < bound)
    return lo + small[0] if small else None


def degree_share(deg: DataFrame) -> DataFrame:
    """Fallback centrality: degree / sum of degrees (0 when the graph has no edges)."""
    total = deg.agg(F.sum("degree")).scalar()
    return deg.select("customer_id", F.coalesce(F.try_divide(F.col("degree").cast("double"), total),
                                                F.lit(0.0)).alias("pagerank"))
