"""Triangles and local clustering coefficient on the undirected simple graph.

Each undirected edge is oriented from the lower to the higher (degree, id) end.
In that orientation every node has at most sqrt(2E) out-neighbours, so the wedge
join (pairs of out-neighbours of one node) is bounded by O(E^1.5) in total and a
hub never expands into deg^2 rows. A wedge closes when its two ends are adjacent;
each triangle is found once and credited to its three corners.

Clustering follows the usual definition: 2T / (d (d - 1)) with d the number of
distinct neighbours other than the node itself; d < 2 -> 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.graph.edges import undirected_edges
from lendnet.session import cut_lineage


def oriented_edges(und: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) once per undirected edge, a ranked below b; plus the degree table."""
    deg = und.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
    ds = deg.select(F.col("node").alias("src"), F.col("deg").alias("ds"))
    dd = deg.select(F.col("node").alias("dst"), F.col("deg").alias("dd"))
    j = und.join(ds, "src").join(dd, "dst")
    lower = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    return j.filter(lower).select(F.col("src").alias("a"), F.col("dst").alias("b")), deg


def triangle_counts(und: DataFrame) -> DataFrame:
    """(node, triangles) for nodes in at least one triangle; ``und`` has no self-loops."""
    o = cut_lineage(oriented_edges(und)[0])      # read twice by the wedge join
    w1 = o.select("a", F.col("b").alias("x"))
    w2 = o.select("a", F.col("b").alias("y"))
    wedges = w1.join(w2, "a").filter(F.col("x") < F.col("y"))
    close = und.select(F.col("src").alias("x"), F.col("dst").alias("y"))
    tri = wedges.join(close, ["x", "y"], "left_semi")
    # one pass over the triangles credits all three corners
    corners = tri.select(F.explode(F.array("a", "x", "y")).alias("node"))
    return corners.groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))


def clustering(customers: DataFrame, edges: DataFrame, und: DataFrame | None = None) -> DataFrame:
    """``und``: the undirected edge set, where the caller has it already (self-loops are dropped)."""
    und = cut_lineage(undirected_edges(edges)) if und is None else und
    und = und.filter("src <> dst")
    deg = und.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    tri = triangle_counts(und)
    j = (customers.select("customer_id")
         .join(deg, deg["node"] == F.col("customer_id"), "left").drop("node")
         .join(tri, tri["node"] == F.col("customer_id"), "left").drop("node"))
    d = F.coalesce(F.col("d"), F.lit(0)).cast("double")
    t = F.coalesce(F.col("triangles"), F.lit(0)).cast("double")
    return j.select("customer_id",
                    F.when(d < 2, F.lit(0.0)).otherwise(F.lit(2.0) * t / (d * (d - F.lit(1.0))))
                    .alias("clustering_coefficient"))
