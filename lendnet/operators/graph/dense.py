"""Dense long node numbers, so that graph loops carry no id strings.

Numbers follow the partitions of a stored node table: position inside the partition plus the sizes of the
partitions before it (one row per partition, broadcast). The stored rows fix them: a retry cannot renumber.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.operators.graph.edges import DST, SRC
from lendnet.session import cut_lineage


def numbered(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with ``id`` = 0 .. n - 1."""
    # a row's number inside its partition is the low part of the monotonic id
    rows = cut_lineage(rows.withColumn("_m", F.monotonically_increasing_id()))
    part, pos = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (rows.withColumn("_p", part).join(F.broadcast(offsets), "_p")
            .withColumn("id", F.col("_off") + pos).drop("_p", "_m", "_off"))


def dense_nodes(customers: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored nodes (node, id, customer) of customers and edge endpoints."""
    names = customers.select(F.col("customer_id").alias("node"), F.lit(True).alias("customer")).unionByName(
        edges.select(F.col(SRC).alias("node"), F.lit(False).alias("customer"))).unionByName(
        edges.select(F.col(DST).alias("node"), F.lit(False).alias("customer")))
    return numbered(names.filter("node IS NOT NULL").groupBy("node").agg(F.max("customer").alias("customer")))


def number_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored collapsed directed edges (src, dst, n = number of parallel edges) between the numbers of ``nodes``;
    a null endpoint stays null."""
    ids = nodes.select("node", "id")
    e = edges.select(F.col(SRC).alias("src"), F.col(DST).alias("dst"))
    return cut_lineage(e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
                       .join(ids.select(F.col("node").alias("src"), F.col("id").alias("s")), "src", "left")
                       .join(ids.select(F.col("node").alias("dst"), F.col("id").alias("d")), "dst", "left")
                       .select(F.col("s").alias("src"), F.col("d").alias("dst"), "n"))


def dense_edges(customers: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``dense_nodes`` and the ``number_edges`` between them that have both endpoints."""
    nodes = dense_nodes(customers, edges)
    return nodes, number_edges(nodes, edges).filter("src IS NOT NULL AND dst IS NOT NULL")
