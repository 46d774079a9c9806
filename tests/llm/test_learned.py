"""Learned operators: held-out accuracy, determinism, and interactions a linear model cannot hold."""

import numpy as np

from helpers import SF01
from lendnet.llm import toxicity
from lendnet.llm.queries import REGISTRY


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = REGISTRY["op1_language_id"][0](spark, SF01).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = REGISTRY["op9_toxicity"][0](spark, SF01).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9
    bad, good = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert np.mean([a > b for a in bad for b in good]) > 0.8


def test_pairwise_interaction():
    """Label 1 only where both terms stand together: no additive weights can separate this."""
    rng = np.random.default_rng(0)
    docs, y = [], []
    for _ in range(2000):
        a, b = rng.random(2) < 0.7
        terms = {int(x) + 10 for x in rng.integers(0, 50, 5)} | ({1} if a else set()) | ({2} if b else set())
        docs.append(np.array(sorted(terms), np.uint64))
        y.append(float(a == b))
    m = toxicity.fit(docs, np.array(y), prior=0.5, terms=64)
    assert {1, 2} <= set(m["keys"].tolist())
    index = {int(k): i for i, k in enumerate(m["keys"])}
    z = []
    for d in docs:
        c = [index[int(t)] for t in d if int(t) in index]
        v = m["v"][c]
        z.append(m["w0"] + m["w"][c].sum() + 0.5 * ((v.sum(0) ** 2) - (v ** 2).sum(0)).sum())
    assert np.mean((np.array(z) > 0) == (np.array(y) > 0.5)) > 0.8
