"""Stress propagation through the network for a whole table of triggers at once.

Semantics (per trigger): breadth-first, first visit wins. The trigger gets the
initial shock at hop 0. A node *falls* when its stress >= threshold; only fallen
nodes with hop < max_hops pass stress on, to neighbours not yet visited:
``child = stress * decay * edge_weight(type) * vulnerability(child)``. A node
reached by several parents in the same hop takes the parent that a FIFO queue
would dequeue first.

Queue order without a queue: a node's queue position is the path of adjacency
ordinals from the trigger (``pos``, an array). Arrays compare lexicographically,
so comparing (parent position, place in parent's adjacency) is comparing
``concat(parent.pos, [adj_ord])``; the adjacency place of a pair is its first edge
ordinal, while its type is the type of its last edge. Each hop is one join of the
fallen frontier with the collapsed adjacency, an anti-join with the visited set and
a ``min_by`` per (trigger, node); no window, no per-trigger task, no Python loop
over rows. The hop count bounds the loop (at most ``max_hops`` steps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lendnet.functions.columns import edge_stress, vulnerability
from lendnet.operators.graph.edges import collapse_edges, collapsed_both_directions
from lendnet.session import cut_lineage, observed


def node_table(customers: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, vuln) for customers and every edge endpoint (non-customers: 1.0)."""
    ends = (edges.select(F.col("src_customer_id").alias("node"))
            .union(edges.select(F.col("dst_customer_id").alias("node"))))
    cust = customers.select(F.col("customer_id").alias("node"),
                            vulnerability("person_income", "loan_amnt").alias("vuln"))
    extra = ends.distinct().join(cust.select("node"), "node", "left_anti").withColumn("vuln", F.lit(1.0))
    return cust.unionByName(extra)


def cascade(customers: DataFrame, edges: DataFrame, triggers: DataFrame, initial_shock: float = 1.0,
            decay: float = 0.6, threshold: float = 0.3, max_hops: int = 5, mode: str = "first_visit",
            order_col: str = "edge_ord") -> DataFrame:
    """Rows (trigger_id, customer_id, hop, stress, fallen, parent, edge_type, pos, stress_raw).

    ``triggers``: (trigger_id, customer_id). Unknown trigger nodes give no rows.
    ``mode='accumulate'``: a node's stress is the sum over all its fallen parents of
    the previous hop (parent and type still from the first-dequeued one).
    """
    from lendnet.operators.clean import validate_cascade_params
    validate_cascade_params(initial_shock, decay, threshold, max_hops)
    nodes = node_table(customers, edges)
    adj = collapsed_both_directions(collapse_edges(edges, order_col))
    # not pre-partitioned on src: AQE may broadcast a small frontier or split a hub's partition
    adj = cut_lineage(adj.join(nodes.withColumnRenamed("node", "dst"), "dst")
                      .select("src", "dst", "edge_type", F.col("first_ord").alias("adj_ord"),
                              edge_stress("edge_type").alias("w"), "vuln"))
    start = (triggers.select("trigger_id", F.col("customer_id").alias("node"))
             .join(nodes.select("node"), "node", "left_semi")
             .select("trigger_id", "node", F.lit(0).alias("hop"), F.lit(float(initial_shock)).alias("stress"),
                     F.array().cast("array<bigint>").alias("pos"), F.lit(None).cast("string").alias("parent"),
                     F.lit(None).cast("string").alias("edge_type")))
    # append-only: every hop writes the rows it reaches, the visited set is the union of the levels
    frontier = state = cut_lineage(start)
    for hop in range(1, max_hops + 1):
        fallen = frontier.filter(F.col("stress") >= F.lit(threshold))
        cand = (fallen.select("trigger_id", F.col("node").alias("src"), F.col("stress").alias("ps"),
                              F.col("pos").alias("ppos"))
                .join(adj, "src")
                .join(state.select("trigger_id", F.col("node").alias("dst")), ["trigger_id", "dst"], "left_anti")
                .select("trigger_id", F.col("dst").alias("node"),
                        F.concat(F.col("ppos"), F.array(F.col("adj_ord").cast("bigint"))).alias("pos"),
                        (F.col("ps") * F.lit(decay) * F.col("w") * F.col("vuln")).alias("s"),
                        F.col("src").alias("parent"), "edge_type"))
        agg = [F.min_by(F.struct("s", "parent", "edge_type", "pos"), F.col("pos")).alias("w")]
        if mode == "accumulate":
            agg.append(F.sum("s").alias("s_sum"))
        nxt = cand.groupBy("trigger_id", "node").agg(*agg)
        stress = F.col("s_sum") if mode == "accumulate" else F.col("w.s")
        nxt = nxt.select("trigger_id", "node", F.lit(hop).alias("hop"), stress.alias("stress"),
                         F.col("w.pos").alias("pos"), F.col("w.parent").alias("parent"),
                         F.col("w.edge_type").alias("edge_type"))
        reached = Observation()
        frontier = cut_lineage(nxt.observe(reached, F.count(F.lit(1)).alias("n")))
        if not observed(reached, "n"):
            break
        state = state.unionByName(frontier)
    return state.select(
        "trigger_id", F.col("node").alias("customer_id"), "hop", F.round("stress", 4).alias("stress"),
        (F.col("stress") >= F.lit(threshold)).alias("fallen"), "parent", "edge_type", "pos",
        F.col("stress").alias("stress_raw"))


def cascade_ordered(result: DataFrame) -> DataFrame:
    """Presentation order: trigger, hop ascending, rounded stress descending, queue position."""
    return result.orderBy("trigger_id", "hop", F.desc("stress"), "pos")


def cascade_summary(result: DataFrame, triggers: DataFrame) -> DataFrame:
    """Per trigger: affected, fallen, max hop, mean (rounded) stress, hop -> count map.

    Triggers without rows get zeros and an empty map.
    """
    by_hop = result.groupBy("trigger_id", "hop").agg(F.count(F.lit(1)).alias("n"))
    hop_map = by_hop.groupBy("trigger_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("hop", "n")))).alias("cascade_by_hop"))
    tot = result.groupBy("trigger_id").agg(
        F.count(F.lit(1)).alias("total_affected"),
        F.sum(F.col("fallen").cast("int")).cast("long").alias("total_fallen"),
        F.max("hop").alias("max_hop"), F.avg("stress").alias("avg_stress"))
    t = triggers.select("trigger_id").distinct()
    j = t.join(tot, "trigger_id", "left").join(hop_map, "trigger_id", "left")
    return j.select(
        "trigger_id", F.coalesce("total_affected", F.lit(0)).alias("total_affected"),
        F.coalesce("total_fallen", F.lit(0)).alias("total_fallen"),
        F.coalesce("max_hop", F.lit(0)).alias("max_hop"),
        F.coalesce("avg_stress", F.lit(0.0)).alias("avg_stress"),
        F.coalesce("cascade_by_hop", F.create_map().cast("map<int,bigint>")).alias("cascade_by_hop"))


def cascade_view(result: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Rows with hop <= depth, and the (parent -> node) edges whose parent is shown."""
    shown = result.filter(F.col("hop") <= depth)
    vis = shown.select("trigger_id", F.col("customer_id").alias("parent"))
    links = (shown.filter(F.col("parent").isNotNull()).join(vis, ["trigger_id", "parent"], "left_semi")
             .select("trigger_id", "parent", F.col("customer_id").alias("child"), "edge_type", "hop"))
    return shown, links
