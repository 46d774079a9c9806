"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the set of a text's hashed terms, so a
pair of terms (an insult next to a group word) carries weight of its own. A term is a run of
letters, digits or non-ASCII characters (A-Z lower-cased); its 4- and 5-byte heads are terms too,
which lets inflected forms share what was learned.

Training reads a bounded sample (``MAX_TRAIN`` labelled documents, half of each label where there are
enough, chosen by a hash of the id). Spark counts the sample's terms and keeps the ``TERMS`` with the largest
chi-square against the label; the driver gets those and, per document, only which of them it holds (long texts
included: at most ``TERMS`` numbers), and fits by AdaGrad. The model (about 1 MB) is broadcast. Scoring is one
map-only pass over whole texts.

Cases: null or empty texts, or texts without a known term, get the base score sigmoid(w0); rows with a
label other than 0 or 1 teach nothing; without any labelled row every score is 0; repeated rows are
scored row by row; columns other than doc_id and text are ignored, so names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import fold_remainder, release_memory, ship, stored
from lendnet.llm.words import PUNCT, words

MAX_TRAIN = 8000
TERMS = 1 << 13
FACTORS = 8
EPOCHS = 12
HEADS = (4, 5)
U = np.uint64


def _term_sets(col: pa.Array, known: np.ndarray | None = None):
    """(row, term hash) of the distinct terms of each text; with ``known`` (a sorted table of 64-bit
    hashes) only those, as (row, index in the table)."""
    if known is not None:
        mask = np.zeros(1 << 20, bool)
        mask[(known & U((1 << 20) - 1)).astype(np.int64)] = True
    for w in words(col, lower=True, separators=PUNCT):
        rows = w.rows() + w.lo
        out_r, out_t = [], []
        for cut in (None, *HEADS):
            if cut is None:
                h, r = w.hashes(), rows
            else:
                long = w.ends - w.starts > cut
                sub = w._replace(starts=w.starts[long])
                h = sub.hashes(sub.starts + cut) ^ U(cut)
                r = rows[long]
            if known is not None:
                hit = mask[(h & U((1 << 20) - 1)).astype(np.int64)]
                h, r = h[hit], r[hit]
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                h, r = at[hit], r[hit]
            out_r.append(r)
            out_t.append(h)
        r, t = np.concatenate(out_r), np.concatenate(out_t)
        if len(r):
            order = np.lexsort((t, r))
            r, t = r[order], t[order]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (t[1:] != t[:-1])
            r, t = r[new], t[new]
        yield w.lo, w.hi, r, t


def _training_rows(batches):
    for b in batches:
        label = b.column("label")
        for lo, hi, r, t in _term_sets(b.column("text")):
            cuts = np.searchsorted(r, np.arange(lo, hi + 1))
            yield pa.RecordBatch.from_arrays(
                [label.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(t.view(np.int64)))],
                names=["label", "terms"])


def _chosen_terms(sample: DataFrame, terms: int) -> np.ndarray:
    """Sorted hashes of the ``terms`` terms with the largest chi-square (above 4, in at least 3 documents)."""
    n, p = sample.agg(F.count(F.lit(1)), F.avg("label")).first()
    p = max(p or 0.0, 1e-6)
    expect = F.col("df") * F.lit(p)
    chi = (F.col("pos") - expect) ** 2 / F.greatest(
        expect * F.lit(1 - p) * (1 - F.col("df") / F.lit(n + 1.0)), F.lit(1e-9))
    best = (sample.select("label", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("df"), F.sum("label").alias("pos")).filter("df >= 3")
            .select("term", chi.alias("chi")).filter("chi > 4").orderBy(F.desc("chi"), "term").limit(terms))
    return np.sort(best.select("term").toArrow().column(0).to_numpy().view(np.uint64))


def _known_terms(ref):
    def run(batches):
        release_memory()
        known = ref.value
        for b in batches:
            col = b.column("terms")
            flat, offsets = col.flatten().to_numpy().view(np.uint64), col.offsets.to_numpy()
            offsets = offsets - offsets[0]
            at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            cuts = np.concatenate([[0], np.cumsum(hit)])[offsets]
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(at[hit].astype(np.int32)))],
                names=["label", "terms"])
    return run


def _interaction(vx: np.ndarray, v2x: np.ndarray) -> np.ndarray:
    return 0.5 * (vx * vx - v2x).sum(axis=1)


def fit(docs: list[np.ndarray], labels: np.ndarray, prior: float, terms: int = TERMS, seed: int = 1) -> dict:
    """Fit on term sets; ``prior`` is the share of label 1 in the whole labelled table."""
    lens = np.array([len(d) for d in docs])
    rows, flat = np.repeat(np.arange(len(docs)), lens), np.concatenate(docs) if len(docs) else np.zeros(0, np.uint64)
    vocab, col, df = np.unique(flat, return_inverse=True, return_counts=True)
    pos = np.bincount(col, weights=labels[rows], minlength=len(vocab))
    n, p = len(docs), max(labels.mean(), 1e-6)
    expect = df * p
    chi = (pos - expect) ** 2 / np.maximum(expect * (1 - p) * (1 - df / (n + 1.0)), 1e-9)
    chi[df < 3] = 0
    keep = np.sort(np.argsort(-chi, kind="stable")[:terms])
    keep = keep[chi[keep] > 4]
    index = np.full(len(vocab), -1)
    index[keep] = np.arange(len(keep))
    sel = index[col] >= 0
    rows, col = rows[sel], index[col[sel]]
    start = np.searchsorted(rows, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    w0, w, v = 0.0, np.zeros(len(keep)), rng.normal(0, 0.01, (len(keep), FACTORS))
    g0, gw, gv = 1e-6, np.full(len(keep), 1e-6), np.full((len(keep), FACTORS), 1e-6)
    weight = np.where(labels == 1, prior / p, (1 - prior) / max(1 - p, 1e-6))
    step, l2 = 0.2, 1e-5
    for _ in range(EPOCHS):
        for chunk in np.array_split(rng.permutation(n), max(1, n // 128)):
            ids = np.concatenate([np.arange(start[i], start[i + 1]) for i in chunk])
            d = np.repeat(np.arange(len(chunk)), start[chunk + 1] - start[chunk])
            c = col[ids]
            vx = np.zeros((len(chunk), FACTORS))
            v2x = np.zeros((len(chunk), FACTORS))
            np.add.at(vx, d, v[c])
            np.add.at(v2x, d, v[c] ** 2)
            z = w0 + np.bincount(d, weights=w[c], minlength=len(chunk)) + _interaction(vx, v2x)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chunk]) * weight[chunk]
            g0 += err.sum() ** 2
            w0 -= step * err.sum() / np.sqrt(g0)
            u, inv = np.unique(c, return_inverse=True)
            dw = np.bincount(inv, weights=err[d], minlength=len(u)) + l2 * w[u]
            dv = np.zeros((len(u), FACTORS))
            np.add.at(dv, inv, err[d][:, None] * (vx[d] - v[c]))
            dv += l2 * v[u]
            gw[u] += dw ** 2
            gv[u] += dv ** 2
            w[u] -= step * dw / np.sqrt(gw[u])
            v[u] -= 0.25 * step * dv / np.sqrt(gv[u])
    return {"keys": vocab[keep], "w0": w0, "w": w, "v": v}


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict | None:
    """Model from ``labels`` (doc_id, toxic) joined to ``docs`` (doc_id, text); None without labels."""
    spark = docs.sparkSession
    ship(spark)
    lab = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IN (0, 1)")
    count = {r["label"]: r["n"] for r in lab.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    if n0 + n1 == 0:
        return None
    want1 = min(n1, max_train // 2)
    want0 = min(n0, max_train - want1)
    rate = F.when(F.col("label") == 1, F.lit(want1 / max(n1, 1))).otherwise(F.lit(want0 / max(n0, 1)))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # about max_train rows of (id, label) by construction: small enough to broadcast at any corpus size
    sample = F.broadcast(lab.filter(draw < rate))
    taught = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
                    .select("label", "text").mapInArrow(_training_rows, "label int, terms array<long>"), "training")
    keys = _chosen_terms(taught, TERMS)
    rows = taught.mapInArrow(_known_terms(spark.sparkContext.broadcast(keys)), "label int, terms array<int>").toArrow()
    if rows.num_rows == 0:
        return None
    y = rows.column("label").to_numpy().astype(float)
    col = rows.column("terms").combine_chunks()
    sets = [keys[x] for x in np.split(col.flatten().to_numpy(), col.offsets.to_numpy()[1:-1] - col.offsets.to_numpy()[0])]
    # a fixed order of training rows, whatever order the tasks finished in
    order = sorted(range(len(y)), key=lambda i: (y[i], len(sets[i]), sets[i][:4].tobytes()))
    return fit([sets[i] for i in order], y[order], prior=n1 / (n0 + n1))


def _score_batches(ref):
    def run(batches):
        release_memory()
        for b in batches:
            score = _scores(ref.value, b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def _scores(m, col: pa.Array) -> np.ndarray:
    score = np.zeros(len(col))
    if m is not None:
        for lo, hi, r, t in _term_sets(col, m["keys"]):
            vx = np.zeros((hi - lo, FACTORS))
            v2x = np.zeros((hi - lo, FACTORS))
            np.add.at(vx, r - lo, m["v"][t])
            np.add.at(v2x, r - lo, m["v"][t] ** 2)
            z = m["w0"] + np.bincount(r - lo, weights=m["w"][t], minlength=hi - lo) + _interaction(vx, v2x)
            score[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return score


def _keep_batches(ref):
    def run(batches):
        release_memory()
        for b in batches:
            yield b.filter(pa.array(_scores(ref.value, b.column("text")) < 0.5))
    return run


def reject(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` (all columns) without the documents predicted toxic."""
    spark = docs.sparkSession
    src = docs.withColumn("text", F.col("text").cast("string"))
    model = train(src.select("doc_id", "text"), labels.filter(fold_remainder("doc_id") != 0), max_train)
    return src.mapInArrow(_keep_batches(spark.sparkContext.broadcast(model)), src.schema)


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    ref = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", (fold_remainder("doc_id") == 0).alias("held_out"), F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_score_batches(ref), f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Train on labelled rows of the folds with remainder 1-4 and score every document."""
    return predict(docs, train(docs, labels.filter(fold_remainder("doc_id") != 0), max_train))
