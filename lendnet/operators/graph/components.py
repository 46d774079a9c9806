"""Connected components of a table of links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``links`` (columns u, v) with a link to another.

    Every round gives each node's larger neighbours, then its smaller ones, to the smallest of them (large-star and
    small-star); a round's links are stored, and the rounds end once they stand still.
    """
    e = cut_lineage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    mark = None
    while True:
        row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == mark or row["n"] == 0:
            break
        mark = (row["n"], row["h"])
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        down = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        e = cut_lineage(moved.unionByName(low.withColumnRenamed("m", "v")).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
