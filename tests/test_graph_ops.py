"""Graph operators on tiny hand-made graphs: multiplicity rules, self-loops, isolates,
missing customers, and the reference's property checks (PageRank sums to 1, distances)."""

import math

import pytest

from conftest import customers_df, edges_df
from lendnet.operators.graph import bfs, edges as GE, hops, pagerank as PR, triangles
from lendnet.operators.graph.features import graph_features

CUST = [("A", 100.0, 10.0, "Y"), ("B", 100.0, 10.0, "N"), ("C", 100.0, 10.0, "N"),
        ("D", 100.0, 10.0, "Y"), ("E", 100.0, 10.0, "N"), ("ISO", 100.0, 10.0, "N")]
# parallel A->B twice, self-loop C, triangle A-B-C, X is not a customer
PAIRS = [("A", "B"), ("A", "B"), ("B", "C"), ("C", "A"), ("C", "C"), ("C", "D"), ("D", "X"), ("X", "E")]


@pytest.fixture(scope="module")
def g(spark):
    return customers_df(spark, CUST), edges_df(spark, PAIRS)


def by_id(df, col):
    return {r.customer_id: r[col] for r in df.collect()}


def test_degrees_count_parallel_edges_and_self_loops(g):
    c, e = g
    deg = {r.customer_id: (r.in_degree, r.out_degree, r.degree) for r in GE.degrees(c, e).collect()}
    assert deg["A"] == (1, 2, 3)
    assert deg["C"] == (2, 3, 5)      # B->C, C->C in; C->A, C->C, C->D out
    assert deg["ISO"] == (0, 0, 0)


def test_one_hop_self_is_neighbour(g):
    c, e = g
    f = by_id(hops.nbr_frac_1hop(c, e), "neighbor_default_frac")
    # C's neighbours: A(Y), B, C itself, D(Y) -> 2/4
    assert f["C"] == pytest.approx(0.5)
    # D's neighbours: C, X (non-customer counts) -> 0/2
    assert f["D"] == 0.0 and f["ISO"] == 0.0


def test_two_hop_through_customers_only(g):
    c, e = g
    f = by_id(hops.nbr_frac_2hop(c, e), "neighbor_default_frac_2hop")
    # D: 1-hop {C, X}; via C -> {A, B, C, D}; via X (not a customer) nothing; minus self and 1-hop -> {A, B}
    assert f["D"] == pytest.approx(0.5)
    # E: 1-hop {X}; X is not a customer -> empty -> 0
    assert f["E"] == 0.0


def test_clustering_ignores_self_loops(g):
    c, e = g
    cc = by_id(triangles.clustering(c, e), "clustering_coefficient")
    assert cc["A"] == pytest.approx(1.0)          # neighbours B, C adjacent
    assert cc["C"] == pytest.approx(2 * 1 / (3 * 2))   # neighbours A, B, D; one triangle
    assert cc["ISO"] == 0.0


def test_bfs_distance(g):
    c, e = g
    dist = by_id(bfs.distance_to_prior_default(c, e), "distance_to_prior_default")
    assert dist["A"] == 0 and dist["D"] == 0 and dist["B"] == 1 and dist["E"] == 2 and dist["ISO"] == -1


def test_bfs_without_defaults_is_all_minus_one(spark, g):
    _, e = g
    c = customers_df(spark, [(x[0], 1.0, 1.0, "N") for x in CUST])
    assert set(by_id(bfs.distance_to_prior_default(c, e), "distance_to_prior_default").values()) == {-1}


def test_pagerank_sums_to_one_with_dangling_and_outside_nodes(spark, g):
    c, e = g
    pr = PR.pagerank(c, e, iters=60)
    # include the non-customer node X in the check through a customer table that has it
    c2 = customers_df(spark, CUST + [("X", 1.0, 1.0, "N")])
    total = sum(by_id(PR.pagerank(c2, e, iters=60), "pagerank").values())
    assert total == pytest.approx(1.0, abs=1e-6)
    vals = by_id(pr, "pagerank")
    assert vals["ISO"] > 0 and all(v > 0 for v in vals.values())


def test_pagerank_matches_power_iteration(spark, g):
    c, e = g
    nodes = sorted({x[0] for x in CUST} | {a for a, _ in PAIRS} | {b for _, b in PAIRS})
    out = {n: sorted({b for a, b in PAIRS if a == n}) for n in nodes}
    r = {n: 1 / len(nodes) for n in nodes}
    for _ in range(20):
        dang = sum(r[n] for n in nodes if not out[n])
        new = {n: 0.15 / len(nodes) + 0.85 * dang / len(nodes) for n in nodes}
        for n in nodes:
            for m in out[n]:
                new[m] += 0.85 * r[n] / len(out[n])
        r = new
    got = by_id(PR.pagerank(c, e, iters=20), "pagerank")
    for k, v in got.items():
        assert v == pytest.approx(r[k], rel=1e-9)


def test_graph_features_schema_and_defaults(g):
    c, e = g
    gf = graph_features(c, e)
    assert gf.columns[0] == "customer_id" and len(gf.columns) == 11
    iso = [r for r in gf.collect() if r.customer_id == "ISO"][0]
    assert (iso.degree, iso.distance_to_prior_default, iso.clustering_coefficient) == (0, -1, 0.0)


def test_collapse_last_type_first_ordinal(spark):
    e = edges_df(spark, [("A", "B"), ("B", "A"), ("A", "B")], ["guarantor", "employer", "co-borrower"])
    r = GE.collapse_edges(e).collect()[0]
    assert (r.edge_type, r.first_ord) == ("co-borrower", 0)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_results_do_not_depend_on_partitioning(spark, g, parts):
    c, e = g
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        gf = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in graph_features(c, e).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    base = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in graph_features(c, e).collect())
    assert gf == base


def test_hub_salting_gives_the_same_results(spark):
    """A star whose hub holds most edges: salted (hub threshold 2) = unsalted results."""
    pairs = [("H", f"L{i}") for i in range(30)] + [(f"L{i}", "H") for i in range(0, 30, 3)] + \
            [("L1", "L2"), ("L2", "L3"), ("L5", "H")]
    cust = [("H", 1.0, 1.0, "Y")] + [(f"L{i}", 1.0, 1.0, "Y" if i % 4 == 0 else "N") for i in range(30)]
    c, e = customers_df(spark, cust), edges_df(spark, pairs)
    plain = by_id(PR.pagerank(c, e, iters=15), "pagerank")
    salted = by_id(PR.pagerank(c, e, iters=15, cell_edges=7), "pagerank")
    assert all(abs(plain[k] - salted[k]) < 1e-12 for k in plain)
    h_plain = by_id(hops.nbr_frac_2hop(c, e), "neighbor_default_frac_2hop")
    h_salted = by_id(hops.nbr_frac_2hop(c, e, hub_min_degree=2), "neighbor_default_frac_2hop")
    assert h_plain == h_salted


def test_hub_list_is_bounded(spark):
    """heavy_keys never returns more than max_hubs keys, whatever the degree distribution."""
    from pyspark.sql import functions as F
    from lendnet.operators.graph.skew import heavy_keys
    deg = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 50 + 1).alias("d"))
    total = deg.agg(F.sum("d").cast("double")).scalar()
    for max_hubs in (1, 10, 100):
        n = heavy_keys(deg, "k", "d", total, min_threshold=0, max_hubs=max_hubs).count()
        assert n <= max_hubs


def test_feature_store_sees_rewritten_tables(spark, tmp_path):
    import os
    import shutil
    from conftest import SF001
    from lendnet.plans.q_graph import graph_features_view
    d = str(tmp_path / "tables")
    os.mkdir(d)                                  # the data folder's own mode may be read-only
    for f in os.listdir(SF001):
        shutil.copyfile(f"{SF001}/{f}", f"{d}/{f}")
    first = graph_features_view(spark, d)
    assert graph_features_view(spark, d).inputFiles() == first.inputFiles()
    n = first.count()
    half = spark.read.parquet(f"{SF001}/customer.parquet").filter("c_custkey % 2 = 0")
    half.coalesce(1).write.parquet(str(tmp_path / "new"))
    (tmp_path / "tables" / "customer.parquet").write_bytes(next((tmp_path / "new").glob("part-*.parquet")).read_bytes())
    assert 0 < graph_features_view(spark, d).count() < n


def brute_2hop(cust, pairs):
    ids, bad = {c[0] for c in cust}, {c[0] for c in cust if c[3] == "Y"}
    nb = {}
    for a, b in pairs:
        nb.setdefault(a, set()).add(b)
        nb.setdefault(b, set()).add(a)
    out = {}
    for c in ids:
        two = {x for m in nb.get(c, ()) if m in ids for x in nb[m]} - nb.get(c, set()) - {c}
        out[c] = len(two & bad) / len(two) if two else 0.0
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_two_hop_bitmaps_equal_brute_force(spark, seed):
    """Hub middles as bitmaps: several hubs, linked hubs, a hub that is no customer, self-loops, isolates."""
    import random
    rng = random.Random(seed)
    n = 70
    cust = [(f"C{i}", 1.0, 1.0, "Y" if rng.random() < 0.3 else "N") for i in range(n)] + [("ISO", 1.0, 1.0, "Y")]
    pairs = [(f"C{rng.randrange(n)}", f"C{rng.randrange(n)}") for _ in range(90)]
    for h in ("C0", "C1", "C2", "X"):
        pairs += [(h, f"C{i}") if rng.random() < 0.5 else (f"C{i}", h) for i in range(n) if rng.random() < 0.4]
    pairs += [("C0", "C1"), ("C2", "C2"), ("X", "Y")]
    c, e = customers_df(spark, cust), edges_df(spark, pairs)
    want = brute_2hop(cust, pairs)
    for least in (20, 5, 10**6):
        got = by_id(hops.nbr_frac_2hop(c, e, hub_min_degree=4, bitmap_min_degree=least), "neighbor_default_frac_2hop")
        assert got == pytest.approx(want)


def test_star_of_many_leaves(spark):
    """10**5 leaves around one hub: no wedge rows of the hub, PageRank and distances on the same star."""
    from pyspark.sql import functions as F
    n = 100_000
    leaves = spark.range(1, n + 1)
    c = leaves.selectExpr("concat('L', id) as customer_id", "1.0d as person_income", "1.0d as loan_amnt",
                          "if(id % 4 = 0, 'Y', 'N') as cb_person_default_on_file").unionByName(
        customers_df(spark, [("H", 1.0, 1.0, "N")]))
    e = leaves.selectExpr("id as edge_ord", "'H' as src_customer_id", "concat('L', id) as dst_customer_id",
                          "cast(null as string) as edge_type")
    f = hops.nbr_frac_2hop(c, e)
    odd = f.filter("customer_id <> 'H'").select(
        F.round("neighbor_default_frac_2hop", 12).alias("s")).distinct().collect()
    assert sorted(r["s"] for r in odd) == [round((n // 4 - 1) / (n - 1), 12), round((n // 4) / (n - 1), 12)]
    assert by_id(f.filter("customer_id = 'H'"), "neighbor_default_frac_2hop") == {"H": 0.0}
    pr = PR.pagerank(c, e, iters=3)
    assert pr.agg(F.sum("pagerank")).first()[0] == pytest.approx(1.0, abs=1e-9)
    d = bfs.distance_to_prior_default(c, e).groupBy("distance_to_prior_default").count().collect()
    assert sorted(tuple(r) for r in d) == [(0, n // 4), (1, 1), (2, n - n // 4)]


def test_pagerank_over_many_blocks_and_cells(spark):
    """Blocks of 8 nodes, cells of 5 edges: hubs as sources and targets, dangling nodes, weights."""
    import random
    rng = random.Random(4)
    pairs = [(f"C{rng.randrange(40)}", f"C{rng.randrange(60)}") for _ in range(150)]
    pairs += [("HUB", f"C{i}") for i in range(60)] + [(f"C{i}", "HUB") for i in range(0, 60, 2)]
    cust = [(f"C{i}", 1.0, 1.0, "N") for i in range(60)] + [("HUB", 1.0, 1.0, "N"), ("ISO", 1.0, 1.0, "N")]
    c, e = customers_df(spark, cust), edges_df(spark, pairs)
    want = power_iterates([x[0] for x in cust], pairs, 7)[7]
    assert by_id(PR.pagerank(c, e, iters=7, cell_edges=5, size=8), "pagerank") == pytest.approx(want, rel=1e-9)
    heavy = by_id(PR.pagerank(c, edges_df(spark, pairs * 3), iters=7, weighted=True, size=16), "pagerank")
    assert heavy == pytest.approx(by_id(PR.pagerank(c, e, iters=7, weighted=True), "pagerank"), rel=1e-9)
    assert by_id(PR.pagerank(c, edges_df(spark, []), iters=3), "pagerank") == pytest.approx(
        {x[0]: 1 / len(cust) for x in cust})


def power_iterates(nodes, pairs, n):
    out = {v: sorted({b for a, b in pairs if a == v}) for v in nodes}
    r = [{v: 1 / len(nodes) for v in nodes}]
    for _ in range(n):
        last = r[-1]
        dangling = sum(last[v] for v in nodes if not out[v])
        new = {v: (0.15 + 0.85 * dangling) / len(nodes) for v in nodes}
        for v in nodes:
            for w in out[v]:
                new[w] += 0.85 * last[v] / len(out[v])
        r.append(new)
    return r


def test_pagerank_tolerance_stops_at_the_first_small_step(spark, g):
    c, e = g
    nodes = sorted({x[0] for x in CUST} | {v for p in PAIRS for v in p})
    r = power_iterates(nodes, PAIRS, 40)
    for tol in (2e-2, 1e-4):
        t = next(i for i in range(1, 41) if sum(abs(r[i][v] - r[i - 1][v]) for v in nodes) < len(nodes) * tol)
        got = by_id(PR.pagerank(c, e, iters=40, tol=tol), "pagerank")
        assert got == pytest.approx({v: r[t][v] for v in got}, rel=1e-9)


def test_feature_jobs_run_on_numbers_and_keep_names(spark, monkeypatch):
    """Parallel edges, a self-loop, an endpoint without a customer, customers without an id or edges."""
    from conftest import customers_df, edges_df
    from lendnet.operators.graph import features as GF, hops
    seen, real = [], hops.nbr_frac_2hop
    monkeypatch.setattr(hops, "nbr_frac_2hop", lambda c, e, *a, **k: seen.append(dict(c.dtypes)) or real(c, e, *a, **k))
    cust = customers_df(spark, [("A", 1.0, 1.0, "Y"), ("B", 1.0, 1.0, "N"), ("C", 1.0, 1.0, "N"), ("D", 1.0, 1.0, "N"),
                                (None, 1.0, 1.0, "N")])
    edges = edges_df(spark, [("A", "B"), ("A", "B"), ("B", "C"), ("C", "X"), ("C", "C")])
    rows = {r.customer_id: r for r in GF.graph_features(cust, edges).collect()}
    assert seen[0]["customer_id"] == "bigint"
    assert set(rows) == {"A", "B", "C", "D", None}
    assert [(rows[k].in_degree, rows[k].out_degree, rows[k].distance_to_prior_default) for k in "ABCD"] == [
        (0, 2, 0), (2, 1, 1), (2, 2, 2), (0, 0, -1)]
    assert [rows[k].neighbor_default_frac for k in "ABCD"] == [0.0, 0.5, 0.0, 0.0]
    assert [rows[k].neighbor_default_frac_2hop for k in "ABCD"] == [0.0, 0.0, 1.0, 0.0]
    assert rows[None].degree == 0 and rows[None].distance_to_prior_default == -1


def test_second_hop_joins_whole_samples(spark):
    from conftest import edges_df
    from lendnet.operators.graph.sampling import two_hop_sample
    out = two_hop_sample(edges_df(spark, [("A", "B"), ("B", "C"), ("A", "A")]), (2, 2), 1)
    assert "collect_list" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [
        ("A", 1, "B"), ("A", 2, "A"), ("A", 2, "C"), ("B", 1, "A"), ("B", 1, "C"), ("B", 2, "B"), ("B", 2, "B"),
        ("C", 1, "B"), ("C", 2, "A"), ("C", 2, "C")]
