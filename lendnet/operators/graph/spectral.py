"""Normalised Laplacian and a distributed spectral embedding.

L = I - D^{-1/2} A D^{-1/2} on the undirected, de-duplicated customer graph (a
self-loop is A_ii = 1; isolated nodes have L_ii = 1 and no off-diagonal entries).

The embedding wants the smallest eigenvectors of L with eigenvalue > 1e-6, scaled
by 1/sqrt(lambda). Eigenvalue 0 needs no iteration: each connected component that has an edge has one such vector,
sqrt(degree) on its nodes, so a graph with more components than wanted vectors is settled by them, and the others
start with them in the basis. The rest is Rayleigh-Ritz on a growing basis (Davidson's method without
a preconditioner): the basis starts with ``SPARE`` random vectors more than are wanted, and every step adds ``ADD``
residuals L v - lambda v: those of the first wanted vectors that have not converged and of the worst spare one. The
spare vectors go on to a residual of ``ROUGH``, so that no copy of an equal eigenvalue stays hidden in them. Basis vectors are kept with their products, so an added vector costs one product with L and
nothing is multiplied twice. A basis of ``MOST`` vectors shrinks to its ``KEEP`` smallest Ritz vectors.

Steps go on until every wanted vector has ||L v - lambda v|| <= ``tol`` (spare: ``ROUGH``) or ``iters`` rounds of ``DEGREE`` steps are
over. Every vector comes with its residual, which bounds the error of
its eigenvalue (L is symmetric: an eigenvalue lies within the residual of lambda); a graph that converges slowly
has a result with larger residuals. Only small matrices summed on the executors reach the driver, never the n-row
table. A table without customers gives no rows; a graph with fewer customers than ``dim`` gives shorter vectors.

Layout: nodes are dense longs, ``SIZE`` of them a block. A block's basis rows and its edges (cells of at most ``SPAN``
target blocks) stay in one partition; a step exchanges only the added vectors' values, summed per target node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.functions.columns import hash_unit
from lendnet.operators.graph.components import components
from lendnet.operators.graph.dense import number_edges, numbered
from lendnet.session import cut_lineage, ensure_checkpoint_dir

TOL = 1e-6                   # largest residual ||L v - lambda v|| of a unit vector
DEGREE = 10                  # steps in one round
SPARE = 4                    # vectors of the first basis beyond the wanted ones
ADD = 3                      # vectors added in a step
ROUGH = 1e-2                 # largest residual of a spare vector
MOST, KEEP = 60, 24          # vectors of a basis at most, and after it shrank
SIZE = 1 << 14               # nodes of a block
SPAN = 64                    # target blocks of a cell


def customer_adjacency(customers: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(A as (i, j) both directions, de-duplicated, customer endpoints only; degree table)."""
    ids = customers.select(F.col("customer_id").alias("i"))
    e = edges.select(F.col("src_customer_id").alias("i"), F.col("dst_customer_id").alias("j"))
    a = e.unionByName(e.select(F.col("j").alias("i"), F.col("i").alias("j"))).distinct()
    a = a.join(ids, "i", "left_semi").join(ids.withColumnRenamed("i", "j"), "j", "left_semi")
    deg = ids.join(a.groupBy("i").agg(F.count(F.lit(1)).alias("d")), "i", "left").select(
        "i", F.coalesce("d", F.lit(0)).alias("d"))
    return a, deg


def norm_laplacian(customers: DataFrame, edges: DataFrame) -> DataFrame:
    """Entries (i, j, value) of L: off-diagonal -1/sqrt(d_i d_j); diagonal 1 - A_ii/d_i (1 for isolates)."""
    a, deg = customer_adjacency(customers, edges)
    di = deg.select("i", F.col("d").alias("di"))
    dj = deg.select(F.col("i").alias("j"), F.col("d").alias("dj"))
    off = (a.filter(F.col("i") != F.col("j")).join(di, "i").join(dj, "j")
           .select("i", "j", (F.lit(-1.0) / F.sqrt(F.col("di") * F.col("dj"))).alias("value")))
    loops = a.filter(F.col("i") == F.col("j")).select("i", F.lit(1).alias("loop"))
    diag = (deg.join(loops, "i", "left")
            .select("i", F.col("i").alias("j"),
                    F.when(F.col("d") == 0, F.lit(1.0))
                    .otherwise(F.lit(1.0) - F.coalesce(F.col("loop"), F.lit(0)) / F.col("d")).alias("value")))
    return off.unionByName(diag)


def _pack_nodes(rows: pa.Table) -> pa.Table:
    """One row for a block's nodes, in the order of their numbers."""
    order = np.argsort(rows.column("at").to_numpy())
    first = np.array(rows.column("first").to_pylist(), dtype=float)[order]
    scale = rows.column("s").to_numpy()[order]
    return pa.table({"block": rows.column("block")[:1], "s": pa.array([scale.tobytes()], pa.binary()),
                     "first": pa.array([first.tobytes()], pa.binary())})


def _pack_edges(rows: pa.Table) -> pa.Table:
    """One row for a cell's edges, by target."""
    src, dst = rows.column("src").to_numpy(), rows.column("dst").to_numpy()
    order = np.argsort(dst, kind="stable")
    return pa.table({"block": rows.column("block")[:1],
                     "src": pa.array([src[order].astype("<i4").tobytes()], pa.binary()),
                     "dst": pa.array([dst[order].astype("<i8").tobytes()], pa.binary())})


def _home(block: int) -> int:
    """Partition of a block: basis, edges and exchanged values of a block share it."""
    return block


def _added(state: tuple, m: np.ndarray) -> np.ndarray:
    """The added vectors' rows of a block: combinations ``m`` of its basis and products."""
    _, q, lq = state
    return np.hstack([q, lq]) @ m


def _values(m: np.ndarray):
    """What a block's added vectors give to its neighbours: (target block, (places, sums))."""
    def run(rows):
        cells: dict = {}
        for block, x in rows:
            if len(x) == 2:
                cells.setdefault(block, []).append(x)
                continue
            u = x[0][:, None] * _added(x, m)
            for src, dst in cells.get(block, []):
                first = np.flatnonzero(np.diff(dst, prepend=-1))
                to, sums = dst[first], np.add.reduceat(u[src], first)
                cut = np.flatnonzero(np.diff(to // SIZE, prepend=-1))
                for lo, hi in zip(cut, np.append(cut[1:], len(to))):
                    yield int(to[lo] // SIZE), ((to[lo:hi] % SIZE).astype("<i4"), sums[lo:hi])
    return run


def _grown(keep: np.ndarray | None, m: np.ndarray):
    """A block's basis and products after a step; ``keep``: combinations that replace them first."""
    def run(rows):
        held: dict = {}
        for block, x in rows:
            if len(x) == 3:
                held[block] = (x, _added(x, m), np.zeros((len(x[0]), m.shape[1])))
            else:
                held[block][2][x[0]] += x[1]
        for block, ((s, q, lq), new, near) in held.items():
            if keep is not None:
                q, lq = q @ keep, lq @ keep
            yield block, (s, np.hstack([q, new]), np.hstack([lq, new - s[:, None] * near]))
    return run


def _grams(e: int):
    """Sums over a partition: basis x added, basis x their products, products x their products."""
    def run(rows):
        total = 0.0
        for _, (_, q, lq) in rows:
            total = total + np.stack([q.T @ q[:, -e:], q.T @ lq[:, -e:], lq.T @ lq[:, -e:]])
        if not np.isscalar(total):
            yield total
    return run


def _bordered(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """A symmetric matrix with the columns ``new`` added."""
    e = new.shape[1]
    out = np.zeros((len(new), len(new)))
    out[:-e, :-e], out[:, -e:], out[-e:, :] = old, new, new.T
    out[-e:, -e:] = (new[-e:] + new[-e:].T) / 2
    return out


def _ritz(g: np.ndarray, h: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, their combinations of the basis, residuals; from basis x basis, x products, products x products."""
    d = 1.0 / np.sqrt(np.maximum(np.diag(g), 1e-300))
    size, u = np.linalg.eigh(g * np.outer(d, d))
    ok = size > 1e-12 * size.max()
    basis = (d[:, None] * u[:, ok]) / np.sqrt(size[ok])
    lam, y = np.linalg.eigh(basis.T @ h @ basis)
    rot = basis @ y
    sq = lambda m: np.einsum("ac,ab,bc->c", rot, m, rot)
    return lam, rot, np.sqrt(np.maximum(sq(s) - 2 * lam * sq(h) + lam ** 2 * sq(g), 0.0))


def _nodes_and_edges(customers: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (id, customer_id, m = rows of the customer, d = degree, comp), comp null without an edge; stored edges
    (src, dst) in both directions, de-duplicated, between the numbers."""
    names = customers.filter("customer_id IS NOT NULL").groupBy(F.col("customer_id").alias("node")).agg(
        F.count(F.lit(1)).alias("m"))
    nodes = numbered(names)
    e = number_edges(nodes, edges).filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst")
    both = cut_lineage(e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    comp = components(e.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    deg = both.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    return cut_lineage(nodes.join(deg, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.col("node").alias("customer_id"), "m", F.coalesce("d", F.lit(0)).alias("d"),
        F.when(F.col("d") > 0, F.coalesce("comp", "id")).alias("comp"))), both


def spectral_pairs(customers: DataFrame, edges: DataFrame, dim: int = 8, iters: int = 60, seed: int = 42,
                   tol: float = TOL) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(customer_id, embedding array<double>), eigenvalues of L kept (ascending), their vectors' residuals."""
    spark = customers.sparkSession
    empty = F.array().cast("array<double>")
    nodes, both = _nodes_and_edges(customers, edges)
    n, rows = nodes.agg(F.count(F.lit(1)), F.max("m")).first()
    want = min(dim + 1, n)
    if n == 0 or iters < 1:
        return customers.select("customer_id", empty.alias("embedding")), np.zeros(0), np.zeros(0)
    # rows of one customer weigh as often as they are there; eigenvalue 0 is known where no customer comes twice
    zero = [] if rows > 1 else nodes.filter("comp IS NOT NULL").groupBy("comp").agg(F.sum("d").alias("vol")).limit(
        want).collect()
    twice = customers.select(F.col("customer_id").alias("i")).join(
        nodes.select(F.col("customer_id").alias("i"), "id", "m"), "i")
    if len(zero) == want:
        v, lam, res, keep = twice.select("i", empty.alias("v")), np.zeros(want), np.zeros(want), []
    else:
        known = [F.when(F.col("comp") == r["comp"], F.sqrt("d") / F.sqrt(F.lit(float(r["vol"])))).otherwise(0.0)
                 for r in zero]
        spare = min(want + SPARE, n) - len(zero)
        first = known + [hash_unit(F.lit(seed), F.col("customer_id"), F.lit(c)) - F.lit(0.5) for c in range(spare)]
        weight = F.when(F.col("d") > 0, F.pow(F.col("m").cast("double"), F.lit(1.5)) / F.sqrt("d")).otherwise(0.0)
        start = nodes.select(F.expr(f"id div {SIZE}").alias("block"), F.expr(f"id % {SIZE}").alias("at"),
                             weight.alias("s"), F.array(*first).alias("first"))
        cells = both.select(F.expr(f"src div {SIZE}").alias("block"), F.expr(f"dst div {SIZE * SPAN}").alias("part"),
                            F.expr(f"src % {SIZE}").alias("src"), "dst")
        state, lam, rot, res = _solve(spark, start, cells, n, len(first), want, iters, tol)
        keep = np.where(lam[:want] > 1e-6)[0][:dim]
        last = rot[:, keep] / np.sqrt(np.maximum(lam[keep], 1e-8))[None, :]
        found = state.flatMap(lambda x: ((x[0] * SIZE + at, v) for at, v in enumerate((x[1][1] @ last).tolist())))
        found = spark.createDataFrame(found, "id long, v array<double>")
        v = cut_lineage(twice.join(found, "id").select("i", F.transform("v", lambda x: x / F.sqrt("m")).alias("v")))
        state.unpersist()
    out = customers.select(F.col("customer_id").alias("i")).join(v, "i", "left")
    return out.select(F.col("i").alias("customer_id"), F.col("v").alias("embedding")), lam[keep], res[keep]


def _solve(spark, start: DataFrame, cells: DataFrame, n: int, k: int, want: int, iters: int, tol: float) -> tuple:
    """(kept (block, (scale, basis, products)), Ritz values, combinations of the basis, residuals)."""
    ensure_checkpoint_dir(spark)
    blocks = -(-n // SIZE)
    parts = min(blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks // 4))

    def opened(r):
        s, q = np.frombuffer(r["s"]), np.frombuffer(r["first"]).reshape(-1, k)
        return r["block"], (s, q, np.zeros_like(q))
    state = start.groupBy("block").applyInArrow(_pack_nodes, "block long, s binary, first binary").rdd.map(
        opened).partitionBy(parts, _home).persist(StorageLevel.MEMORY_AND_DISK)
    near = cells.groupBy("block", "part").applyInArrow(_pack_edges, "block long, src binary, dst binary").rdd.map(
        lambda r: (r["block"], (np.frombuffer(r["src"], "<i4"), np.frombuffer(r["dst"], "<i8")))).partitionBy(
        parts, _home).persist(StorageLevel.MEMORY_AND_DISK)
    mats = np.zeros((3, 0, 0))
    # the first vectors are added as they are
    keep, m, steps = np.zeros((k, 0)), np.eye(2 * k, k), (iters - 1) * DEGREE
    while True:
        given = near.union(state).mapPartitions(_values(m)).partitionBy(parts, _home)
        grown = state.union(given).mapPartitions(
            _grown(keep if keep.shape[1] != len(keep) else None, m), preservesPartitioning=True).persist(
            StorageLevel.MEMORY_AND_DISK)
        if keep.shape[1] != len(keep):
            grown.checkpoint()                   # a shrunk basis is stored, so a lost executor repeats the steps since
        new = sum(grown.mapPartitions(_grams(m.shape[1])).collect())
        state.unpersist()
        state = grown
        mats = np.stack([_bordered(keep.T @ old @ keep, x) if old.size else _bordered(old, x)
                         for old, x in zip(mats, new)])
        lam, rot, res = _ritz(*mats)
        bad, spare = np.flatnonzero(res[:want] > tol), want + np.flatnonzero(res[want:want + SPARE] > ROUGH)
        spare = spare[np.argsort(-res[spare], kind="stable")]
        bad = np.append(bad[:max(ADD - 1, ADD - len(spare))], spare)[:ADD]
        if not len(bad) or steps <= 0:
            near.unpersist()
            return state, lam, rot, res
        steps -= 1
        # residuals as unit vectors, from basis and products
        m = np.vstack([-rot[:, bad] * lam[bad], rot[:, bad]]) / res[bad]
        keep = rot[:, :KEEP] if len(rot) + len(bad) > MOST else np.eye(len(rot))


def spectral_embedding(customers: DataFrame, edges: DataFrame, dim: int = 8, iters: int = 60, seed: int = 42,
                       tol: float = TOL) -> tuple[DataFrame, np.ndarray]:
    """``spectral_pairs`` without the residuals."""
    return spectral_pairs(customers, edges, dim, iters, seed, tol)[:2]
