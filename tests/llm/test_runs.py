"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from helpers import SF001, edge_docs, empty_docs, words_of
from lendnet.llm import runs
from lendnet.llm.queries import REGISTRY, cycled


def brute(w, exponent=4, least=6):
    out = set()
    for q in range(1, len(w) // exponent + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, n = i - q, j - i + q
            if n >= max(least, exponent * q) and not any(
                    all(w[x] == w[x - p] for x in range(s + p, s + n)) for p in range(1, q)):
                out.add((s, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def names(words):
    return np.array([hash(("w", x)) for x in words], np.int64)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, letters = rng.randint(0, 160), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randint(0, letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n > 4 else 0):
            s = rng.randrange(n)
            p, e = rng.randint(1, max(1, (n - s) // 3)), rng.randint(s, n)
            w[s:e] = [w[s + (i - s) % p] for i in range(s, e)]
        for exponent in (3, 4):
            assert [tuple(r) for r in runs.find_runs(names(w), n, exponent).tolist()] == brute(w, exponent)


def test_hard_words_are_fast_and_right():
    a, b = "a", "ab"
    while len(b) < 200_000:
        a, b = b, b + a
    assert len(runs.find_runs(names(b), len(b))) == 0           # Fibonacci words hold no fourth power
    assert len(runs.find_runs(names(b[:3000]), 3000, 3)) == len(brute(b[:3000], 3))
    t = names(["a"] * 300_000)
    assert runs.find_runs(t, len(t)).tolist() == [[0, 300_000, 1]]
    t = names([i % 50_000 for i in range(200_001)])
    assert runs.find_runs(t, len(t)).tolist() == [[0, 200_001, 50_000]]
    with pytest.raises(ValueError):
        runs.find_runs(t, len(t), 2)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    w = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w) if n < 700 else [tuple(r) for r in runs.find_runs(names(w), n).tolist()]
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = (None,) * 4
    if found:
        s, m, q = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
        best = (s, m, q, 1000 * m // q)
    return (doc_id, len(found), *best, digest("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r) for r in REGISTRY["op13_periodic_runs"][0](spark, SF001).collect()}
    assert got == {i: expected(i, t) for i, t in texts.items()}
    assert sum(1 for r in got.values() if r[1]) > 5


def test_edge_rows_and_long_texts(spark, monkeypatch):
    out = runs.periodic_runs(edge_docs(spark)).collect()
    assert len(out) == edge_docs(spark).count()
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[1]["n_words"] == by[3]["n_words"] == 0 and by[1]["collapsed"] == "" and by[1]["runs"] == []
    assert [tuple(r) for r in by[13]["runs"]] == [(0, 6, 1)] and by[13]["collapsed"] == "tie"
    assert len(by[10]["runs"]) == 1 and len(by[10]["collapsed"].split()) == by[10]["n_words"] // 40
    assert runs.periodic_runs(empty_docs(spark)).count() == 0
    assert cycled(edge_docs(spark)).count() == len(out) and cycled(empty_docs(spark)).count() == 0
    # a text of several slices: words never break at a cut, runs span it
    rng = random.Random(2)
    words = [str(rng.random()) for _ in range(40_000)]
    words[20_000:38_000] = [words[20_000 + i % 3_000] for i in range(18_000)]
    raw = " \n".join(words).encode()
    assert [x.decode() for w in runs.slices(raw, 1000) for x in w] == words
    df = spark.createDataFrame([(1, raw.decode()), (2, "x" * 3_000_000), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(20_000, 18_000, 3_000)]
    assert got[1]["collapsed"] == " ".join(words[:23_000] + words[38_000:])
    assert got[2]["collapsed"] == "x" * 3_000_000 and got[2]["runs"] == []
