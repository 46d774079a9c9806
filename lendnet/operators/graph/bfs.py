"""Multi-source breadth-first distance on the undirected collapsed network.

One frontier loop for all sources at once (never one search per node). Levels are
append-only: each step joins the last level with the adjacency, removes the nodes of
the last two levels (a neighbour of level d lies in level d - 1, d or d + 1) and
writes the next level, so a loop writes each reached node once. The loop runs for as
many steps as the graph's eccentricity from the source set, one job a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lendnet.operators.graph.edges import undirected_edges
from lendnet.session import cut_lineage, observed


def multi_source_bfs(und: DataFrame, sources: DataFrame, max_depth: int | None = None,
                     cut: bool = True) -> DataFrame:
    """(node, dist) for every node reachable from ``sources`` (column ``node``); ``cut=False`` where
    ``und`` is stored already."""
    # not pre-partitioned: a small frontier is broadcast; a large one goes through a shuffle
    # join where AQE can split a hub's partition
    adj = cut_lineage(und.select("src", "dst")) if cut else und.select("src", "dst")
    levels = [cut_lineage(sources.select("node").distinct().withColumn("dist", F.lit(0)))]
    while max_depth is None or len(levels) <= max_depth:
        near = levels[-1] if len(levels) == 1 else levels[-1].unionByName(levels[-2])
        nxt = (levels[-1].join(adj, F.col("node") == F.col("src")).select(F.col("dst").alias("node"))
               .distinct().join(near.select("node"), "node", "left_anti")
               .withColumn("dist", F.lit(len(levels))))
        found = Observation()
        nxt = cut_lineage(nxt.observe(found, F.count(F.lit(1)).alias("n")))
        if not observed(found, "n"):
            break
        levels.append(nxt)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def distance_to_prior_default(customers: DataFrame, edges: DataFrame,
                              flag_col: str = "cb_person_default_on_file", und: DataFrame | None = None) -> DataFrame:
    """0 at prior-default customers, hops to the nearest one elsewhere, -1 when unreachable."""
    from lendnet.operators.graph.hops import default_flags
    src = default_flags(customers, flag_col).filter(F.col("d") == 1).select("node")
    dist = multi_source_bfs(undirected_edges(edges), src) if und is None else multi_source_bfs(und, src, cut=False)
    return (customers.select("customer_id").join(dist, dist["node"] == F.col("customer_id"), "left")
            .select("customer_id", F.coalesce(F.col("dist"), F.lit(-1)).cast("int")
                    .alias("distance_to_prior_default")))
