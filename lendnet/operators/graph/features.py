"""The 11-column graph feature table for every customer (H8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.graph import bfs, edges as GE, hops, pagerank as PR, triangles
from lendnet.operators.graph.dense import dense_nodes, number_edges
from lendnet.schemas import GRAPH_FEATURES
from lendnet.session import cut_lineage


def graph_features(customers: DataFrame, edges: DataFrame, pagerank: str = "simple",
                   flag_col: str = "cb_person_default_on_file", pagerank_iters: int = 20,
                   materialize_inputs: bool = True) -> DataFrame:
    """Degrees, log-normalised degrees, PageRank, distance to prior default, clustering,
    1- and 2-hop default shares, left-joined on ``customer_id`` with defaults 0 / 0.0 / -1.

    ``pagerank``: 'simple' (collapsed edges), 'weighted' (parallel edges as weights) or
    'degree_share' (degree / sum of degrees). Inputs are checkpointed once so the seven
    feature jobs read a materialised copy instead of re-deriving the tables.
    """
    cust = customers.select("customer_id", flag_col)
    e = edges.select(GE.SRC, GE.DST)
    if materialize_inputs:
        cust = cut_lineage(cust)
        e = cut_lineage(e)
    # every feature job runs on dense numbers: the names are met once, here, and again at the end
    nodes = dense_nodes(cust, e)
    links = number_edges(nodes, e)
    cust = cut_lineage(cust.join(nodes.select(F.col("node").alias("customer_id"), "id"), "customer_id", "left")
                       .select(F.col("id").alias("customer_id"), flag_col))
    e = links.select(F.col("src").alias(GE.SRC), F.col("dst").alias(GE.DST), "n")
    deg = GE.norm_degree(cut_lineage(GE.degrees(cust, e, times="n")))
    if pagerank == "degree_share":
        pr = PR.degree_share(deg)
    else:
        pr = PR.pagerank(cust, e, iters=pagerank_iters, weighted=(pagerank == "weighted"),
                         dense=(nodes.select(F.col("id").alias("node"), "id"),
                                links.filter("src IS NOT NULL AND dst IS NOT NULL")))
    # the undirected edge set once, for the four operators that read it
    und = cut_lineage(GE.undirected_edges(e))
    dist = bfs.distance_to_prior_default(cust, e, flag_col, und=und)
    clus = triangles.clustering(cust, e, und=und)
    h1 = hops.nbr_frac_1hop(cust, e, flag_col, und=und)
    h2 = hops.nbr_frac_2hop(cust, e, flag_col, und=und)
    out = deg
    for part in (pr, dist, clus, h1, h2):
        out = out.join(part, "customer_id", "left")
    out = (out.withColumnRenamed("customer_id", "id").join(
        nodes.select("id", F.col("node").alias("customer_id")), "id", "left").drop("id"))
    # one materialised feature table: the mart, training and scoring all read it
    return cut_lineage(out.select("customer_id", *[
        F.coalesce(F.col(c), F.lit(-1 if c == "distance_to_prior_default" else 0)).alias(c)
        if c in ("degree", "in_degree", "out_degree", "distance_to_prior_default")
        else F.coalesce(F.col(c), F.lit(0.0)).alias(c)
        for c in GRAPH_FEATURES]))


def features_from_source(spark, data_dir: str) -> DataFrame:
    """H9: detect the source under ``data_dir`` (edge list or flat borrower file) and build the
    graph feature table. Flat files get customer ids from their row order and links from
    ``bucket_links``; edge lists get one customer per distinct endpoint, with the borrower columns of
    ``network_borrowers``."""
    from lendnet.operators.clean import clean_customers
    from lendnet.operators.features_extra import quartile_bucket
    from lendnet.operators.graph.borrowers import network_borrowers
    from lendnet.operators.graph.sampling import bucket_links
    from lendnet.operators.order import with_row_ids
    from lendnet.sources.files import load_source
    kind, df = load_source(spark, data_dir)
    if kind == "network":
        return graph_features(network_borrowers(df), df)
    rows = with_row_ids(df.withColumn("_mono", F.monotonically_increasing_id()), ["_mono"], name="row_ord",
                        prefix=None)
    cust = clean_customers(rows.withColumn("customer_id", F.concat(F.lit("CUST_"), F.col("row_ord").cast("string"))))
    links = bucket_links(quartile_bucket(cust, "person_income"), ["loan_intent", "bucket"])
    e = links.withColumn("edge_ord", F.monotonically_increasing_id())
    return graph_features(cust, e)
