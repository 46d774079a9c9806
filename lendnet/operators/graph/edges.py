"""Edge-table operators: degrees, collapsed/undirected views, node sets, adjacency.

Multiplicity matters: degrees count parallel edges; PageRank, BFS and clustering use
the collapsed graph; neighbour shares use de-duplicated undirected neighbour sets.
All aggregations are one shuffle with map-side partial aggregation, so a hub that
holds a large share of edges is pre-combined before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SRC, DST = "src_customer_id", "dst_customer_id"
CHUNK = 1024               # neighbours of one adjacency row at most


def endpoint_counts(edges: DataFrame, src: str = SRC, dst: str = DST, times: str | None = None) -> DataFrame:
    """(node, in_degree, out_degree) over nodes that occur in ``edges``; one shuffle. ``times``: column with the
    number of parallel edges of a collapsed row."""
    one = F.lit(1) if times is None else F.col(times)
    both = (edges.select(F.col(src).alias("node"), F.lit(0).alias("i"), one.alias("o"))
            .unionByName(edges.select(F.col(dst).alias("node"), one.alias("i"), F.lit(0).alias("o"))))
    return both.groupBy("node").agg(F.sum("i").cast("int").alias("in_degree"),
                                    F.sum("o").cast("int").alias("out_degree"))


def degrees(customers: DataFrame, edges: DataFrame, times: str | None = None) -> DataFrame:
    """In / out / total degree of every customer, counting parallel edges; 0 if none."""
    cnt = endpoint_counts(edges, times=times).withColumnRenamed("node", "customer_id")
    j = customers.select("customer_id").join(cnt, "customer_id", "left")
    i = F.coalesce(F.col("in_degree"), F.lit(0))
    o = F.coalesce(F.col("out_degree"), F.lit(0))
    return j.select("customer_id", (i + o).alias("degree"), i.alias("in_degree"), o.alias("out_degree"))


def norm_degree(deg: DataFrame) -> DataFrame:
    """Add log1p(d) / log1p(max(max d, 1)) for in and out degree (max over the table)."""
    mx = deg.agg(F.greatest(F.max("in_degree"), F.lit(1)).alias("mi"),
                 F.greatest(F.max("out_degree"), F.lit(1)).alias("mo"))
    max_in = mx.select("mi").scalar()
    max_out = mx.select("mo").scalar()
    return deg.withColumns({
        "norm_in_degree": F.log1p("in_degree") / F.log1p(max_in),
        "norm_out_degree": F.log1p("out_degree") / F.log1p(max_out),
    })


def degree_full_outer(edges: DataFrame) -> DataFrame:
    """In- and out-degree merged by full outer join, missing side -> 0."""
    ind = edges.groupBy(F.col(DST).alias("customer_id")).agg(F.count(F.lit(1)).alias("in_degree"))
    outd = edges.groupBy(F.col(SRC).alias("customer_id")).agg(F.count(F.lit(1)).alias("out_degree"))
    j = ind.join(outd, "customer_id", "full")
    return j.select("customer_id",
                    F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
                    F.coalesce("out_degree", F.lit(0)).alias("out_degree"))


def net_ratio(deg: DataFrame) -> DataFrame:
    """clip((out - in) / (total + 1), -1, 1)."""
    r = (F.col("out_degree") - F.col("in_degree")) / (F.col("degree") + F.lit(1.0))
    return deg.withColumn("net_ratio", F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))


def node_set(edges: DataFrame, src: str = SRC, dst: str = DST) -> DataFrame:
    """Distinct endpoints (isolated customers are not in it)."""
    return (edges.select(F.col(src).alias("node"))
            .union(edges.select(F.col(dst).alias("node"))).distinct())


def directed_simple(edges: DataFrame) -> DataFrame:
    """Collapsed directed graph: one row per ordered pair (self-loops kept)."""
    return edges.select(F.col(SRC).alias("src"), F.col(DST).alias("dst")).distinct()


def undirected_edges(edges: DataFrame, keep_self_loops: bool = True) -> DataFrame:
    """Both directions of every edge, de-duplicated: (src, dst)."""
    e = edges.select(F.col(SRC).alias("src"), F.col(DST).alias("dst"))
    u = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    if not keep_self_loops:
        u = u.filter(F.col("src") != F.col("dst"))
    return u


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Unordered pair as (least, greatest), sorted."""
    return (edges.select(F.least(SRC, DST).alias("a"), F.greatest(SRC, DST).alias("b"), "edge_type")
            .orderBy("a", "b", "edge_type"))


def collapse_edges(edges: DataFrame, order_col: str = "edge_ord") -> DataFrame:
    """Undirected simple graph for cascades: one row per unordered pair.

    The edge type is the one of the *last* edge of the pair (later insertions overwrite
    the attribute); ``first_ord`` is the first edge of the pair (adjacency position).
    """
    a, b = F.least(SRC, DST), F.greatest(SRC, DST)
    return (edges.select(a.alias("a"), b.alias("b"), F.col("edge_type"), F.col(order_col).alias("ord"))
            .groupBy("a", "b")
            .agg(F.max_by("edge_type", "ord").alias("edge_type"), F.min("ord").alias("first_ord")))


def collapsed_both_directions(collapsed: DataFrame) -> DataFrame:
    """(src, dst, edge_type, first_ord) in both directions; a self-loop appears once."""
    fwd = collapsed.select(F.col("a").alias("src"), F.col("b").alias("dst"), "edge_type", "first_ord")
    back = (collapsed.filter(F.col("a") != F.col("b"))
            .select(F.col("b").alias("src"), F.col("a").alias("dst"), "edge_type", "first_ord"))
    return fwd.unionByName(back)


def adjacency(edges: DataFrame) -> DataFrame:
    """node -> sorted array of distinct undirected neighbours (self-loop: own neighbour)."""
    u = undirected_edges(edges)
    return u.groupBy(F.col("src").alias("node")).agg(F.array_sort(F.collect_set("dst")).alias("neighbors"))


def adjacency_chunks(positions: DataFrame, size: int = CHUNK) -> DataFrame:
    """(node, chunk, neighbors, n): a node's sorted neighbours in rows of at most ``size``, so that a hub is many
    rows of bounded width. ``positions``: (src, dst, pos) with pos = 0, 1, ... inside src in the order of dst."""
    return (positions.groupBy(F.col("src").alias("node"), F.floor(F.col("pos") / F.lit(size)).cast("long").alias("chunk"))
            .agg(F.array_sort(F.collect_list("dst")).alias("neighbors"), F.count(F.lit(1)).alias("n")))


def node_avg_time(edges: DataFrame, ts_col: str = "ts_epoch") -> DataFrame:
    """Mean edge time per node over both endpoint roles (bag union; a self-loop counts twice)."""
    both = (edges.select(F.col(SRC).alias("node"), F.col(ts_col).alias("t"))
            .unionAll(edges.select(F.col(DST).alias("node"), F.col(ts_col).alias("t"))))
    return both.groupBy("node").agg(F.avg("t").alias("avg_ts"), F.count(F.lit(1)).alias("n_times"))


def crisis_exposure(customers: DataFrame, edges: DataFrame, start: float, end: float,
                    missing_ts: float, ts_col: str = "ts_epoch") -> DataFrame:
    """1.0 when the node's mean edge time lies in [start, end], else 0.0; no edges -> missing_ts."""
    avg = node_avg_time(edges, ts_col).withColumnRenamed("node", "customer_id")
    j = customers.select("customer_id").join(avg, "customer_id", "left")
    t = F.coalesce(F.col("avg_ts"), F.lit(float(missing_ts)))
    return j.select("customer_id", t.alias("avg_ts"),
                    F.when(t.between(F.lit(float(start)), F.lit(float(end))), 1.0).otherwise(0.0)
                    .alias("crisis_exposure"))
