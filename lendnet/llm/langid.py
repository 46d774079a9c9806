"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample (``MAX_DOCS_PER_LANG`` labelled documents of each
language, chosen by a hash of the id) in Spark; the log-probability matrix (languages x 3 x 2**15)
is broadcast and every whole text is scored batch by batch with numpy gathers.

Cases: null or empty text, or text without a letter, gives ``und`` with score 0; documents with a
null language teach nothing; with no labelled document at all every text is ``und``; repeated rows
and ids are scored row by row; ties go to the alphabetically first language; only ``doc_id``,
``text`` and ``lang`` are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import fold_remainder, ship
from lendnet.llm.words import splitmix, text_buffer

BITS = 15
ORDERS = (1, 2, 3)
SIZE = len(ORDERS) << BITS           # hashed n-gram cells, plus one silent cell
MAX_DOCS_PER_LANG = 1000             # expected size of the training sample of one language
ALPHA = 0.5
BLOCK = 1 << 18                      # code points scored at a time
U = np.uint64


def _fold(cp: np.ndarray) -> np.ndarray:
    """Lower-case ASCII letters; other ASCII characters become one separator (0)."""
    low = np.where((cp >= 65) & (cp <= 90), cp + 32, cp)
    return np.where((low < 128) & ~((low >= 97) & (low <= 122)), 0, low).astype(np.uint64)


def _cells(cp: np.ndarray):
    """For each n-gram order: the hashed cell of the n-gram ending at each code point."""
    f = _fold(cp)
    acc = np.zeros(len(f), np.uint64)
    letters = np.zeros(len(f), bool)
    for k, n in enumerate(ORDERS):
        shifted = np.zeros(len(f), np.uint64)
        shifted[n - 1:] = f[:len(f) - n + 1] if n > 1 else f
        acc = acc * U(0x100000001B3) + shifted + U(1)
        letters = letters | (shifted > 0)
        cell = (splitmix(acc + U(n)) >> U(64 - BITS)).astype(np.int64) + (k << BITS)
        yield np.where(letters, cell, SIZE)


def _texts(col: pa.Array):
    """(row, code points) of every text."""
    raw, offsets = text_buffer(col)
    for r in range(len(offsets) - 1):
        cp = np.frombuffer(raw[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "replace").encode("utf-32-le"),
                           dtype=np.uint32)
        yield r, cp


def _batches(col: pa.Array):
    """Concatenated code points of several rows with row starts; rows are separated by a separator.

    A text longer than a block is cut into blocks; each begins with the last code points of the one before, as
    context of its first n-grams. ``skip`` are the places of such context, whose own n-grams were counted before,
    and of separators inside a text, so a text of any length has exactly the n-grams of the whole text.
    """
    context = len(ORDERS) - 1
    rows, parts, skip, size = [], [], [], 0
    for r, cp in _texts(col):
        for at in range(0, max(len(cp), 1), BLOCK):
            lead = min(at, context)
            piece = cp[at - lead:at + BLOCK]
            skip += range(size, size + lead)
            rows.append(r)
            parts.append(piece)
            parts.append(np.zeros(context, np.uint32))
            size += len(piece) + context
            if at + BLOCK < len(cp):           # the text goes on: no n-gram ends at this separator
                skip += range(size - context, size)
            if size >= BLOCK:
                yield np.array(rows), parts, skip
                rows, parts, skip, size = [], [], [], 0
    if rows:
        yield np.array(rows), parts, skip


def _count_batches(langs):
    index = {name: i for i, name in enumerate(langs)}

    def run(batches):
        counts = np.zeros((len(langs), SIZE + 1), np.int64)
        for b in batches:
            lang = np.array([index[x] for x in b.column("lang").to_pylist()])
            for rows, parts, skip in _batches(b.column("text")):
                cp = np.concatenate(parts)
                who = np.repeat(lang[rows], [len(parts[2 * i]) + len(parts[2 * i + 1]) for i in range(len(rows))])
                for cell in _cells(cp):
                    cell[skip] = SIZE
                    counts += np.bincount(who * (SIZE + 1) + cell, minlength=counts.size).reshape(counts.shape)
        counts[:, SIZE] = 0
        li, ci = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(li, pa.int32()), pa.array(ci, pa.int32()), pa.array(counts[li, ci], pa.int64())],
            names=["li", "cell", "n"])
    return run


def train(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> dict:
    """Model from labelled documents: language names, log-probabilities and log-priors.

    ``docs`` has doc_id, text, lang. The sample rate of a language is its bound over its count, so
    the sample holds about ``max_docs_per_lang`` documents of each language at any corpus size.
    """
    spark = docs.sparkSession
    ship(spark)
    known = docs.filter(F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": [], "logp": np.zeros((SIZE + 1, 0), np.float32), "prior": np.zeros(0)}
    rate = F.lit(0.0)
    for name in langs:
        rate = F.when(F.col("lang") == name, F.lit(min(1.0, max_docs_per_lang / counts[name]))).otherwise(rate)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.filter(draw < rate).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    cells = (sample.mapInArrow(_count_batches(langs), "li int, cell int, n long")
             .groupBy("li", "cell").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros((len(langs), SIZE + 1))
    total[cells.column("li").to_numpy(), cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    logp = np.zeros((SIZE + 1, len(langs)), np.float32)
    for k in range(len(ORDERS)):     # each order is a multinomial of its own
        part = total[:, k << BITS:(k + 1) << BITS] + ALPHA
        logp[k << BITS:(k + 1) << BITS] = np.log(part / part.sum(axis=1, keepdims=True)).T
    n = np.array([counts[x] for x in langs], float)
    return {"langs": langs, "logp": logp, "prior": np.log(n / n.sum())}


def _score_batches(model_ref):
    def run(batches):
        m = model_ref.value
        langs, logp, prior = np.array(m["langs"] + ["und"], dtype=object), m["logp"], m["prior"]
        for b in batches:
            texts, n = b.column("text"), b.num_rows
            ll = np.zeros((n, len(prior))) + prior
            seen = np.zeros(n, bool)
            for rows, parts, skip in _batches(texts):
                cp = np.concatenate(parts)
                sizes = np.array([len(parts[2 * i]) + len(parts[2 * i + 1]) for i in range(len(rows))])
                starts = np.cumsum(sizes) - sizes
                for k, cell in enumerate(_cells(cp)):
                    cell[skip] = SIZE
                    for j in range(len(prior)):
                        np.add.at(ll[:, j], rows, np.add.reduceat(logp[:, j][cell].astype(np.float64), starts))
                letter = ((cp | 32) >= 97) & ((cp | 32) <= 122) & (cp < 128)
                seen[rows[np.add.reduceat(letter, starts) > 0]] = True
            for r in np.flatnonzero(~seen):
                t = texts[r].as_py()
                seen[r] = bool(t) and any(map(str.isalpha, t))
            if len(prior):
                best = ll.argmax(axis=1)
                score = 1.0 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, score, seen = np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
            best = np.where(seen, best, len(langs) - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(langs[best].tolist(), pa.string()),
                 pa.array(np.where(seen, score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    ref = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", (fold_remainder("doc_id") == 0).alias("held_out"), F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_score_batches(ref), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> DataFrame:
    """Train on the folds with remainder 1-4 and predict every document."""
    taught = docs.select("doc_id", "text", "lang").filter(fold_remainder("doc_id") != 0)
    return predict(docs, train(taught, max_docs_per_lang))
