"""The bare network source: edge order independent of splits, borrowers, non-trivial graph features."""

import os
import random

from lendnet.operators.graph.features import features_from_source
from lendnet.sources import files as SF


def write_network(path, n, seed=3):
    rng = random.Random(seed)
    os.makedirs(path)
    pairs = [(rng.randrange(n // 4), rng.randrange(n // 4)) for _ in range(n)]
    with open(f"{path}/edges.csv", "w") as f:
        f.write("# source,target,weight,timestamp\n")
        f.writelines(f" {a}, {b}, 1, {rng.choice((1_100_000_000, 1_200_000_000))}\n" for a, b in pairs)
    return pairs


def test_two_split_sizes_give_the_same_order(spark, tmp_path):
    pairs = write_network(str(tmp_path / "prosper_user_loans_2016"), 3000)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("2k", "17k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            kind, df = SF.load_source(spark, str(tmp_path))
            got = sorted((r["edge_ord"], r["src_customer_id"], r["dst_customer_id"]) for r in df.collect())
            assert kind == "network" and got == [(i, f"PROSPER_{a}", f"PROSPER_{b}") for i, (a, b) in enumerate(pairs)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_features_of_a_network_are_not_trivial(spark, tmp_path):
    pairs = write_network(str(tmp_path / "prosper_user_loans_2016"), 1200)
    rows = features_from_source(spark, str(tmp_path)).collect()
    assert len(rows) == len({x for p in pairs for x in p})
    dist = {r["distance_to_prior_default"] for r in rows}
    assert 0 in dist and 1 in dist and len({r["neighbor_default_frac"] for r in rows}) > 5
    assert len({r["neighbor_default_frac_2hop"] for r in rows}) > 5
