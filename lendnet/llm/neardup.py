"""MinHash near-duplicates: minima, bands, signature check, full-set confirmation, star components.

1. One map-only pass gives every document the size, a 128-bit fingerprint and the band keys of its shingle
   set (``BANDS`` bands of ``ROWS`` universal-hash minima). Documents with equal sets form one class, and only
   the class's smallest id goes on.
2. A bucket is a band key that several classes share. Every member is linked to the bucket's smallest id where
   the signatures allow it (``SIGNATURE_FLOOR``) and the full sets confirm it: one candidate per member, not one
   per pair.
3. Components of those links leave few open questions: members of one bucket in different components. Outsiders
   of a bucket (members outside its largest component) are compared on full sets with all of that
   component's members and with each other, in blocks of bounded size. So every pair that shares a bucket
   is either in one component or has been compared: no link between components is lost to hubs.
4. Components come from alternating large-star and small-star steps on the link table.

A pair at similarity 0.8 misses all 30 bands of 5 with probability below 1e-5, and its signature share
falls below the floor of 0.62 (5.5 standard deviations) with probability below 1e-6; sets are compared by
64-bit shingle hashes.

Cases: null or empty text has an empty set, size 0, no link, and is its own component; a text shorter than a
shingle is one shingle; rows that repeat a doc_id count as one document (all its texts' links hold);
rows with a null doc_id are linked with nothing, get a null component and are kept; extra columns are
not read. ``deduplicate`` works on rows: where ids repeat, every row gets its own stored key, and one row of
each component stays (smallest doc_id, then text hash); rows that only share an id are not linked, rows with
empty texts or null ids all stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import free_name, release_memory, ship, stored
from lendnet.llm.words import row_windows, splitmix, windows, words
from lendnet.session import cut_lineage

BANDS, ROWS = 30, 5
SIGNATURE_FLOOR = 0.62
PERCENT = 80                 # similarity threshold in percent
MEMBERS, QUERIES = 512, 2048  # documents in one comparison block
BROADCAST_IDS = 1_000_000    # candidate ids are broadcast up to this many (about 30 MB), joined beyond
U = np.uint64


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift hash functions: odd multipliers and offsets from a fixed counter."""
    x = splitmix(np.arange(1, 2 * n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
    return (x[:n] | U(1))[:, None], x[n:][:, None]


_MUL, _ADD = _family(BANDS * ROWS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over a non-empty set."""
    low = None
    for at in range(0, len(shingles), 1024):
        part = ((_MUL * shingles[None, at:at + 1024] + _ADD) >> U(32)).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def _sets(col: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of every text with a word."""
    for w in words(col, lower=True):
        h = w.hashes()
        at, sh = row_windows(h, w.first, k)
        cut = np.searchsorted(at, w.first)
        for r in range(w.hi - w.lo):
            n = w.first[r + 1] - w.first[r]
            if n >= k:
                yield w.lo + r, np.unique(sh[cut[r]:cut[r + 1]])
            elif n:
                yield w.lo + r, windows(h[w.first[r]:w.first[r + 1]], int(n)) ^ U(n)


def _features(k: int):
    salt = np.arange(BANDS, dtype=np.uint64) * U(0x9E3779B97F4A7C15)

    def run(batches):
        release_memory()
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            fp: list = [None] * b.num_rows
            keys: list = [None] * b.num_rows
            for r, s in _sets(b.column("text"), k):
                n[r] = len(s)
                fp[r] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                m = signature(s).reshape(BANDS, ROWS)
                acc = salt.copy()
                for j in range(ROWS):
                    acc = splitmix(acc ^ m[:, j]) + U(j)
                keys[r] = acc.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(fp, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "fp", "keys"])
    return run


def _set_rows(k: int):
    def run(batches):
        release_memory()
        for b in batches:
            rows, sets, sigs = [], [], []
            for r, s in _sets(b.column("text"), k):
                rows.append(r)
                sets.append(s.view(np.int64))
                sigs.append(signature(s).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sets, pa.list_(pa.int64())),
                 pa.array(sigs, pa.list_(pa.int64()))], names=["node", "shingles", "sig"])
    return run


def _compare_block(percent: int):
    """Links between the members and the queries of one block, found by counting shared shingles."""
    def run(pdf):
        import pandas as pd
        members = pdf[pdf["role"] != 1]
        queries = pdf[pdf["role"] != 0]
        names, sets, comps = (members[c].to_numpy() for c in ("node", "shingles", "comp"))
        a, b = [], []
        if len(sets) and len(queries):
            size = np.array([len(s) for s in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for q, s in zip(queries["node"].to_numpy(), queries["shingles"].to_numpy()):
                s = np.asarray(s)
                lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                count = hi - lo
                hits = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                shared = np.bincount(owner[hits], minlength=len(sets))
                linked = np.flatnonzero(100 * shared >= percent * (size + len(s) - shared))
                seen = set()         # one link into each component is enough
                for i in linked:
                    if names[i] != q and comps[i] not in seen:
                        seen.add(comps[i])
                        a.append(q)
                        b.append(names[i])
        return pd.DataFrame({"a": pd.Series(a, dtype=pdf["node"].dtype), "b": pd.Series(b, dtype=pdf["node"].dtype)})
    return run


# ---- connected components ----------------------------------------------------------------------

def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``links`` (columns u, v).

    Alternates large-star and small-star until the edge set stands still; each round is cut by a
    reliable checkpoint, so a lost executor repeats one round.
    """
    e = cut_lineage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    mark = None
    while True:
        row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == mark or row["n"] == 0:
            break
        mark = (row["n"], row["h"])
        e = cut_lineage(_small_star(_large_star(e)))
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


# ---- candidates and confirmation ---------------------------------------------------------------

def _confirmed(links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) whose signatures agree enough and whose full sets reach the threshold."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("sig").alias("ga"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("sig").alias("gb"))
    agree = F.size(F.filter(F.arrays_zip("ga", "gb"), lambda x: x["ga"] == x["gb"]))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (links.join(a, "a").join(b, "b")
            .filter(agree >= F.lit(int(SIGNATURE_FLOOR * BANDS * ROWS)))
            .filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b"))


def _open_blocks(members: DataFrame, comp: DataFrame) -> DataFrame:
    """(gid, role, node, comp): blocks that compare each bucket's outsiders with its largest component
    and with each other. Roles: 0 member, 1 query, 2 both."""
    # the narrow tables below are read several times each: stored, so that the plan stays small
    m = cut_lineage(members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    sizes = m.select("node", "comp").distinct().groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    per = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")).join(sizes, "comp")
    top = per.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("t"), F.count(F.lit(1)).alias("parts"),
                                 (F.sum("n")).alias("n_all"), F.max_by("n", F.struct("size", "comp")).alias("n_top"))
    # the pool is compared inside itself only where its members lie in several components
    top = cut_lineage(top.filter("parts > 1").select("key", F.col("t.comp").alias("top"), F.col("t.size").alias("top_size"),
                                                     "parts", (F.col("n_all") - F.col("n_top")).alias("pool")))
    out = cut_lineage(m.join(top, "key").filter("comp <> top"))
    spread = lambda blocks: F.pmod(F.xxhash64("node"), blocks)
    # outsiders against the top component: member blocks x query chunks
    asked = cut_lineage(out.select("top", "top_size", "node", "comp").distinct())
    shape = asked.groupBy("top", "top_size").agg(F.count(F.lit(1)).alias("q")).select(
        "top", F.ceil(F.col("top_size") / MEMBERS).alias("mb"), F.ceil(F.col("q") / QUERIES).alias("qb"))
    q = asked.drop("top_size").join(shape, "top").withColumn("j", spread(F.col("qb"))).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)))
    own = m.select("node", "comp").distinct().join(shape, F.col("comp") == F.col("top")).withColumn(
        "i", spread(F.col("mb"))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
    gid = F.concat_ws(":", F.lit("c"), F.col("top").cast("string"), F.col("i").cast("string"), F.col("j").cast("string"))
    against = q.select(gid.alias("gid"), F.lit(1).alias("role"), "node", "comp").union(
        own.select(gid.alias("gid"), F.lit(0).alias("role"), "node", "comp"))
    # outsiders among themselves, block pairs (i <= j)
    pool = out.filter("parts > 2").withColumn("nb", F.ceil(F.col("pool") / MEMBERS)).withColumn(
        "i", spread(F.col("nb"))).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    pid = F.concat_ws(":", F.lit("p"), F.col("key").cast("string"), F.least("i", "o").cast("string"),
                      F.greatest("i", "o").cast("string"))
    role = F.when(F.col("i") == F.col("o"), 2).when(F.col("i") < F.col("o"), 0).otherwise(1)
    return against.union(pool.select(pid.alias("gid"), role.alias("role"), "node", "comp"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    feats = stored(src.mapInArrow(_features(k), f"doc_id {kind}, n_shingles long, fp binary, keys array<long>"),
                   "minhash")
    known = feats.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # a class's documents have the same keys: its smallest id carries them on
    reps = stored(known.groupBy("fp").agg(F.min(F.struct("doc_id", "keys")).alias("r"))
                  .select("fp", F.col("r.doc_id").alias("node"), F.col("r.keys").alias("keys")), "classes")
    bands = reps.select("node", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(bands.join(shared.select("key", "hub"), "key"), "buckets")
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    small = nodes.count() <= BROADCAST_IDS
    rows = src.join(F.broadcast(nodes) if small else nodes, "doc_id", "left_semi")
    sets = stored(rows.mapInArrow(_set_rows(k), f"node {kind}, shingles array<long>, sig array<long>"), "sets")
    stars = members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = _confirmed(stars, sets, percent).select(F.col("a").alias("u"), F.col("b").alias("v"))
    # rows that repeat an id with another text tie that id's classes together
    rep = known.select("doc_id", "fp").join(reps.select("fp", F.col("node").alias("rep")), "fp")
    first = rep.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi")
    tied = rep.join(first, "doc_id").filter("rep <> lo").select(F.col("rep").alias("u"), F.col("lo").alias("v"))
    links = cut_lineage(links.union(tied).distinct())
    blocks = _open_blocks(members.select("key", "node"), components(links))
    more = (blocks.join(sets.select("node", "shingles"), "node").groupBy("gid")
            .applyInPandas(_compare_block(percent), f"a {kind}, b {kind}")
            .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    comp = components(links.union(more))
    whole = feats.select("doc_id", "n_shingles", "fp").join(
        reps.select("fp", F.col("node").alias("rep")), "fp", "left").join(
        comp.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "rep")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id")).select(
        "doc_id", "n_shingles", "component_id",
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows of each group but the one with the smallest id (all columns kept)."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1").isEmpty():       # no id repeats: the id is the row's key
        verdict = near_duplicates(docs, k, percent).filter("NOT kept").select("doc_id")
        return docs.join(verdict, "doc_id", "left_anti").select(docs.columns)
    row = free_name(docs, "row")
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    named = keyed.filter("doc_id IS NOT NULL")
    groups = near_duplicates(named.select(F.col(row).alias("doc_id"), "text"), k, percent).select(
        F.col("doc_id").alias(row), "component_id")
    order = named.select(row, F.struct("doc_id", F.xxhash64(F.col("text").cast("string")).alias("h"), row).alias("o"))
    kept = groups.join(order, row).groupBy("component_id").agg(F.min("o").alias("o")).select(F.col(f"o.{row}").alias(row))
    return (named.join(kept, row, "left_semi").select(docs.columns)
            .unionByName(keyed.filter("doc_id IS NULL").select(docs.columns)))
