"""Walks, skip-gram pairs, Word2Vec and the spectral embedding (property checks)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import customers_df, edges_df
from lendnet.operators.graph import spectral as SP, walks as WK


@pytest.fixture(scope="module")
def ring(spark):
    n = 12
    pairs = [(f"N{i}", f"N{(i + 1) % n}") for i in range(n)] + [("N0", "N6")]
    cust = [(f"N{i}", 1.0, 1.0, "N") for i in range(n)]
    return customers_df(spark, cust), edges_df(spark, pairs)


def test_walks_follow_edges_and_are_deterministic(spark, ring):
    _, e = ring
    w1 = WK.random_walks(e, walks_per_node=2, length=6, p=0.5, q=2.0, seed=3)
    w2 = WK.random_walks(e, walks_per_node=2, length=6, p=0.5, q=2.0, seed=3)
    a = sorted((r.walk_id, tuple(r.path)) for r in w1.collect())
    assert a == sorted((r.walk_id, tuple(r.path)) for r in w2.collect())
    und = {(x.src_customer_id, x.dst_customer_id) for x in e.collect()}
    und |= {(b, a_) for a_, b in und}
    assert len(a) == 24
    for _, path in a:
        assert len(path) == 6 and all((path[i], path[i + 1]) in und for i in range(5))


def test_skipgram_pairs_window(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"])], "id int, toks array<string>")
    got = sorted((r.center, r.context) for r in WK.skipgram_pairs(df, "toks", 1, ["id"]).collect())
    assert got == [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]


def test_word2vec_on_walks(spark, ring):
    _, e = ring
    walks = WK.random_walks(e, walks_per_node=2, length=5, seed=1)
    vecs = WK.walk_embeddings(walks, dim=4)
    assert vecs.count() == 12


def test_spectral_embedding_is_eigen(spark, ring):
    c, e = ring
    emb, lam = SP.spectral_embedding(c, e, dim=3, iters=150)
    assert len(lam) == 3 and np.all(lam > 1e-6) and np.all(np.diff(lam) >= -1e-9)
    # the ring with a chord is connected: the first kept eigenvalue is the Fiedler value, < 1
    assert lam[0] < 1.0
    rows = {r.customer_id: np.array(r.embedding) for r in emb.collect()}
    assert len(rows) == 12 and all(len(v) == 3 for v in rows.values())


def test_no_walker_is_lost_on_a_star_and_isolates_stay(spark):
    star = edges_df(spark, [("H", f"L{i}") for i in range(4)])
    nodes = spark.createDataFrame([(x,) for x in ["H", "L0", "L1", "L2", "L3", "alone"]], "node string")
    # a return costs 1/1000 of a step, but a leaf has nowhere else to go
    w = WK.random_walks(star, nodes, walks_per_node=20, length=4, p=1000.0, q=1.0, seed=1, cheap_rounds=2).collect()
    assert len(w) == 120
    assert all(r.path == ["alone"] for r in w if r.start == "alone")
    assert all(len(r.path) == 4 for r in w if r.start != "alone")
    exact = WK.random_walks(star, nodes, walks_per_node=5, length=3, p=50.0, q=50.0, cheap_rounds=0).collect()
    assert len(exact) == 30


def test_registered_spectral_embedding_is_converged(spark):
    from conftest import SF001
    from lendnet.plans import q_embed as Q
    rows = {r.customer_id: r.embedding for r in Q.spectral_embedding(spark, SF001).collect()}
    ids = sorted(rows)
    at = {x: n for n, x in enumerate(ids)}
    lap = np.zeros((len(ids), len(ids)))
    for r in SP.norm_laplacian(Q.FX.customers(spark, SF001), Q.FX.edges(spark, SF001)).collect():
        lap[at[r.i], at[r.j]] = r.value
    v = np.array([rows[x] for x in ids])
    want = np.linalg.eigvalsh(lap)[:9]
    want = want[want > 1e-6]
    v = v * np.sqrt(want)                               # unit vectors again
    assert np.allclose(np.linalg.norm(v, axis=0), 1.0, atol=1e-5)
    assert np.linalg.norm(lap @ v - v * want, axis=0).max() < 1e-5


def test_registered_walk_embeddings_take_the_whole_walks(spark, monkeypatch):
    from conftest import SF001
    from lendnet.plans import q_embed as Q
    seen, train = [], WK.walk_embeddings
    monkeypatch.setattr(WK, "walk_embeddings", lambda walks, **kw: seen.append(walks) or train(walks, **kw))
    rows = Q.walk_embeddings(spark, SF001).collect()
    customers = {r.customer_id for r in Q.FX.customers(spark, SF001).collect()}
    assert customers <= {r.customer_id for r in rows} and all(len(r.embedding) == 32 for r in rows)
    sizes = [len(r.path) for r in seen[0].collect()]
    assert len(sizes) == 2 * len(customers) and max(sizes) == 10


def test_exact_steps_follow_the_biased_weights(spark, monkeypatch):
    """Only exact steps (no proposals): shares of next nodes against 1/p, 1, 1/q; chunks of three neighbours."""
    from collections import Counter
    from conftest import edges_df
    from lendnet.operators.graph import walks as W
    monkeypatch.setattr(W, "CHUNK", 3)
    monkeypatch.setattr(W, "adjacency_chunks", lambda adj, size=3, real=W.adjacency_chunks: real(adj, size))
    e = edges_df(spark, [("A", "H"), ("A", "B")] + [("H", x) for x in "BCDEFG"] + [("B", "C")])
    p, q = 4.0, 0.5
    rows = W.random_walks(e, nodes=spark.createDataFrame([("A",)], "node string"), walks_per_node=3000, length=3,
                          p=p, q=q, cheap_rounds=0).collect()
    assert len(rows) == 3000 and all(len(r["path"]) == 3 for r in rows)
    first = Counter(r["path"][1] for r in rows)
    assert abs(first["H"] / 3000 - 0.5) < 0.04
    nb = {"H": set("ABCDEFG"), "A": set("HB"), "B": set("AHC")}
    for cur in "HB":
        seen = Counter(r["path"][2] for r in rows if r["path"][1] == cur)
        w = {x: 1 / p if x == "A" else 1.0 if x in nb["A"] else 1 / q for x in nb[cur]}
        for x in w:
            assert abs(seen[x] / sum(seen.values()) - w[x] / sum(w.values())) < 0.05


def test_star_keeps_all_walks(spark):
    """p = 1000 sends every proposal back from the leaves, q = 4 most of them at the hub: no walk is lost."""
    from lendnet.operators.graph.walks import random_walks
    n = 10_000
    e = spark.range(n).selectExpr("id as edge_ord", "'H' as src_customer_id", "concat('L', id) as dst_customer_id",
                                  "cast(null as string) as edge_type")
    w = random_walks(e, walks_per_node=1, length=4, p=1000.0, q=4.0, cheap_rounds=2)
    assert w.count() == n + 1 and w.filter("size(path) <> 4").count() == 0
    assert w.filter("path[1] <> 'H' and start <> 'H'").count() == 0


def test_spectral_results_of_slow_tiny_and_empty_graphs(spark):
    """A long path converges slowly: after one round there is a result whose residuals bound the eigenvalues' error."""
    n = 60
    c = customers_df(spark, [(f"N{i:02d}", 1.0, 1.0, "N") for i in range(n)])
    e = edges_df(spark, [(f"N{i:02d}", f"N{i + 1:02d}") for i in range(n - 1)])
    emb, lam, res = SP.spectral_pairs(c, e, dim=3, iters=1)
    assert emb.count() == n and len(lam) == len(res) == 3 and res.max() > SP.TOL
    exact = 1 - np.cos(np.pi * np.arange(n) / (n - 1))
    assert all(np.abs(exact - x).min() <= r + 1e-12 for x, r in zip(lam, res))
    emb, lam, res = SP.spectral_pairs(customers_df(spark, []), edges_df(spark, []), dim=3)
    assert emb.count() == 0 and len(lam) == len(res) == 0
    two = customers_df(spark, [("A", 1.0, 1.0, "N"), ("B", 1.0, 1.0, "N")])
    emb, lam, res = SP.spectral_pairs(two, edges_df(spark, [("A", "B")]), dim=3)
    assert np.allclose(lam, [2.0]) and {len(r["embedding"]) for r in emb.collect()} == {1}


def _plain_walks(edges, starts, k, length, p, q, seed, rounds):
    """The documented draws, one walker at a time (without walkers that need an exact step)."""
    import hashlib

    def u(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / (1 << 52)
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    top, out = max(1 / p, 1, 1 / q), {}
    for s in starts:
        for i in range(k):
            path = [s]
            for step in range(1, length):
                cur, prev = path[-1], path[-2] if len(path) > 1 else None
                for r in range(rounds):
                    nb = sorted(near[cur])
                    x = nb[int(u(seed, f"{s}|{i}", step, r, "pick") * len(nb))]
                    w = top if prev is None else 1 / p if x == prev else 1.0 if x in near[prev] else 1 / q
                    if u(seed, f"{s}|{i}", step, r, "acc") < w / top:
                        path.append(x)
                        break
                else:
                    path = None
                    break
            out[f"{s}|{i}"] = path
    return out


def test_all_rounds_of_a_walk_step_are_one_job(spark):
    pairs = sorted({tuple(sorted((f"N{i}", f"N{(i * j + 3) % 30}"))) for i in range(30) for j in (2, 5, 7)
                    if i != (i * j + 3) % 30})
    sc = spark.sparkContext
    sc.setJobGroup("walk-step", "walks")
    got = {r.walk_id: r.path for r in WK.random_walks(edges_df(spark, pairs), walks_per_node=3, length=6, p=0.5, q=2.0,
                                                      seed=9, cheap_rounds=12).collect()}
    jobs = len(sc.statusTracker().getJobIdsForGroup("walk-step"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    want = _plain_walks(pairs, sorted({x for e in pairs for x in e}), 3, 6, 0.5, 2.0, 9, 12)
    assert set(got) == set(want) and all(p is None or got[w] == p for w, p in want.items())
    assert jobs < 200          # 12 rounds of 5 steps took several jobs each


def test_word2vec_training_is_dealt_over_tasks(spark, ring, monkeypatch):
    import pyspark.ml.feature as ML
    seen, real = [], ML.Word2Vec.fit

    def fit(self, walks):
        seen.append(self.getNumPartitions())
        return real(self, walks)
    monkeypatch.setattr(ML.Word2Vec, "fit", fit)
    monkeypatch.setattr(WK, "TASK_TOKENS", 50, raising=False)
    walks = spark.createDataFrame([([f"N{(i + j) % 12}" for j in range(5)],) for i in range(36)], "path array<string>")
    assert WK.walk_embeddings(walks, dim=4).count() == 12
    assert seen == [4]         # 180 path nodes, 50 a task


def _jobs_of(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    out = run()
    jobs = len(sc.statusTracker().getJobIdsForGroup(name))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


def test_components_settle_eigenvalue_zero(spark):
    """Twelve triangles, a loop and a lone node: the four smallest eigenvalues are 0, which takes no product with L."""
    pairs = [(f"T{t}{a}", f"T{t}{b}") for t in range(12) for a, b in ("xy", "yz", "zx")] + [("loop", "loop")]
    names = sorted({x for p in pairs for x in p} | {"lone"})
    (emb, lam, res), jobs = _jobs_of(spark, "spectral-zero", lambda: SP.spectral_pairs(
        customers_df(spark, [(x, 1.0, 1.0, "N") for x in names]), edges_df(spark, pairs), dim=3))
    assert emb.schema["embedding"].dataType.simpleString() == "array<double>"
    assert {(r.customer_id, tuple(r.embedding)) for r in emb.collect()} == {(x, ()) for x in names}
    assert len(lam) == len(res) == 0 and jobs < 60


def test_spectral_steps_find_equal_eigenvalues_over_blocks(spark, monkeypatch):
    """A hub with 12 equal arms has eigenvalues 11 times; blocks of 16 nodes, cells of one block, a basis
    that shrinks."""
    for name, value in (("SIZE", 16), ("SPAN", 1), ("MOST", 26), ("KEEP", 14)):
        monkeypatch.setattr(SP, name, value, raising=False)
    pairs = [(("hub" if k == 0 else f"a{a}-{k - 1}"), f"a{a}-{k}") for a in range(12) for k in range(4)]
    c = customers_df(spark, [(x, 1.0, 1.0, "N") for x in sorted({x for p in pairs for x in p})])
    e = edges_df(spark, pairs)
    (emb, lam, res), jobs = _jobs_of(spark, "spectral-steps", lambda: SP.spectral_pairs(c, e, dim=8))
    rows = {r.customer_id: r.embedding for r in emb.collect()}
    at = {x: n for n, x in enumerate(sorted(rows))}
    lap = np.zeros((len(at), len(at)))
    for r in SP.norm_laplacian(c, e).collect():
        lap[at[r.i], at[r.j]] = r.value
    assert np.allclose(lam, np.linalg.eigvalsh(lap)[1:9], atol=1e-9) and res.max() <= SP.TOL
    v = np.array([rows[x] for x in sorted(rows)]) * np.sqrt(lam)
    assert np.allclose(v.T @ v, np.eye(8), atol=1e-6) and np.linalg.norm(lap @ v - v * lam, axis=0).max() < 1e-5
    assert jobs < 160


def test_rows_of_one_customer_and_null_ids(spark):
    """A customer that comes twice: a row for each pair of its rows; an embedding is null without an id."""
    ids = ["A", "B", "C", "D", "A", None]
    c = customers_df(spark, [(x, 1.0, 1.0, "N") for x in ids])
    emb = SP.spectral_embedding(c, edges_df(spark, [("A", "B"), ("B", "C"), ("C", "D"), ("D", None)]), dim=1)[0].collect()
    assert sorted(str(r.customer_id) for r in emb) == ["A", "A", "A", "A", "B", "C", "D", "None"]
    assert [r.embedding for r in emb if r.customer_id is None] == [None]


def _ring_with_chords(n=30):
    return sorted({tuple(sorted((f"N{i}", f"N{(i * j + 3) % n}"))) for i in range(n) for j in (2, 5, 7)
                   if i != (i * j + 3) % n})


def test_walks_cost_no_job_per_step_without_hubs(spark):
    """A step is a join of the walkers with their nodes' rows; nothing has to be looked at between two steps."""
    e = edges_df(spark, _ring_with_chords())
    jobs = [_jobs_of(spark, f"walks-{n}", lambda n=n: WK.random_walks(e, walks_per_node=1, length=n, q=0.5).count())[1]
            for n in (3, 8)]
    # a step adds the map stage of its join (its own checkpoint and observation took several jobs)
    assert jobs[1] - jobs[0] <= 2 * 5, jobs


@pytest.mark.parametrize("carry,part", [(256, 3), (256, 1), (4, 10), (4, 2), (0, 10)])
def test_hubs_and_parts_change_no_walk(spark, monkeypatch, carry, part):
    """Walkers at or behind a hub step by joins, the others in their row; paths stored in parts come back in order."""
    monkeypatch.setattr(WK, "CARRY", carry, raising=False)
    monkeypatch.setattr(WK, "PART", part, raising=False)
    pairs = _ring_with_chords()
    nodes = spark.createDataFrame([(x,) for x in sorted({x for e in pairs for x in e}) + ["alone", "alone"]], "node string")
    got = {r.walk_id: r.path for r in WK.random_walks(edges_df(spark, pairs + [("N1", "N1"), pairs[0]]), nodes, 2, 7, 0.5, 2.0,
                                                      seed=5, cheap_rounds=12).collect()}
    want = _plain_walks(pairs, sorted({x for e in pairs for x in e}), 2, 7, 0.5, 2.0, 5, 12)
    assert [got.pop(f"alone|{k}") for k in (0, 1)] == [["alone"]] * 2
    assert set(got) == set(want) and all(len(p) == 7 for p in got.values())
    assert all(p is None or got[w] == p for w, p in want.items())


def test_exact_step_of_a_row_and_of_a_hub_agree(spark, monkeypatch):
    e, walks = edges_df(spark, _ring_with_chords()), []
    for carry in (256, 0):
        monkeypatch.setattr(WK, "CARRY", carry, raising=False)
        rows = WK.random_walks(e, walks_per_node=3, length=6, p=4.0, q=0.25, seed=2, cheap_rounds=0).collect()
        walks.append({r.walk_id: (r.start, r.path) for r in rows})
    assert walks[0] == walks[1] and len(walks[0]) == 90
