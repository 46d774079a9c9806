"""Nearest vectors by Hilbert windows: the curve itself, recall against brute force, ties, copies and odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF001
from lendnet.llm import curves
from lendnet.llm.queries import REGISTRY


@pytest.mark.parametrize("dims,bits", [(2, 5), (3, 3), (4, 2)])
def test_curve_visits_neighbouring_cells(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = curves.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(x, ids, every=100, k=10):
    out = {}
    for q in sorted(set(ids[ids % every == 0].tolist())):
        d = np.full(len(x), np.inf)
        for i in np.flatnonzero(ids == q):
            d = np.minimum(d, np.sqrt(((x - x[i]) ** 2).sum(axis=1)))
        best = {}
        for j in np.lexsort((ids, d)):
            if ids[j] != q and len(best) < k:
                best.setdefault(int(ids[j]), d[j])
        out[q] = list(best.items())
    return out


def frame(spark, x, ids):
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)],
                                 "vec_id long, embedding array<float>")


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_query_on_the_smallest_table(spark):
    t = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in t], np.float64), np.array([r["vec_id"] for r in t])
    got, want = found(REGISTRY["op12_nearest_vectors"][0](spark, SF001)), brute(x, ids)
    assert got.keys() == want.keys() and recall(got, want) == 1.0        # one window holds so small a table
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-15)


def test_recall_without_structure_and_in_clusters(spark):
    rng = np.random.default_rng(3)
    loose = rng.normal(size=(9000, 32))
    tight = np.repeat(rng.normal(size=(12, 32)) * 3, 500, axis=0) + rng.normal(size=(6000, 32)) * 0.05
    x = np.concatenate([loose, tight]).astype(np.float32).astype(np.float64)
    ids = rng.permutation(len(x)) + 1
    df = frame(spark, x, ids).repartition(4).cache()
    assert recall(found(curves.nearest(df)), brute(x, ids)) >= 0.9
    # clusters alone: narrow windows are enough
    src, length, n = curves._usable(frame(spark, tight, np.arange(len(tight))))
    index, reach = curves.fit(src, src, length, n, 10)
    assert reach < 0.15 and len(index.splits[0]) > 10
    assert recall(found(curves.nearest(frame(spark, tight, np.arange(len(tight))))),
                  brute(tight.astype(np.float32).astype(np.float64), np.arange(len(tight)))) >= 0.9


def test_copies_and_small_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 8)).astype(np.float32).astype(np.float64)
    x[rng.random(3000) < 0.4] = x[0]                     # one vector holds a good third of all rows
    x[10:14] = x[10]
    ids = rng.permutation(3000)
    want = brute(x, ids)
    src, _, _ = curves._usable(frame(spark, x, ids))
    kept = curves._candidates(src, 10)
    crowd = kept.filter(F.expr(f"v[0] = float('{np.float32(x[0][0])}')")).count()
    assert crowd == 11 and kept.count() < 1900
    monkeypatch.setattr(curves, "GROUP_ROWS", 200)       # hot ranges over many groups
    got = found(curves.nearest(frame(spark, x, ids).repartition(3)))
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    copies = [q for q in want if (x[np.flatnonzero(ids == q)[0]] == x[0]).all()]
    assert copies and all(got[q] == want[q] for q in copies)             # ties: the smallest ids


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [5.0, 5.0]), (1, [1.0, 0.0]), (2, [5.0, 4.0]), (3, None), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, []), (200, [2.0, 0.0]),
            (300, None), (-100, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("score", "v", "h1", "query_id", "rank", "curve", "range", "n", "draw"):
        df = df.withColumn(c, F.lit("clash"))
    got = found(curves.nearest(df))
    assert got[0] == [(1, 0.0), (2, 1.0), (200, 1.0), (-100, 2.0)]
    assert [i for i, _ in got[200]] == [-100, 0, 1, 2] and set(got) == {0, 200, -100}
    assert curves.nearest(df.filter("false")).count() == 0
    assert curves.nearest(df.filter("vec_id in (3, 4, 300)")).count() == 0
    ints = spark.createDataFrame([(100, [1, 2]), (1, [1, 3])], "vec_id int, embedding array<int>")
    assert found(curves.nearest(ints)) == {100: [(1, 1.0)]}
