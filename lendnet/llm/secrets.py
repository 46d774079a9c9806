"""Secret scans over a trigram inverted index.

Each rule's regular expression yields a Boolean query over the trigrams any match must contain
(lower-cased). The index holds, for every trigram some rule asks for, the sorted keys of the documents
that contain it, cut into blocks of documents so that no posting list grows without bound. A block's
postings are intersected and united as the queries say, the candidates are joined to their documents,
and the expressions verify them. Rules without a mandatory trigram (long hexadecimal runs) scan every
document, in the same pass.

Spans are code points, end exclusive; matches are leftmost and non-overlapping within a kind, and a match
that fails its length check is dropped after it has consumed its text.

Cases: null or empty text has no spans; repeated rows are scanned row by row (keys are hashes of the id, so
rows that share a key only share candidates); an empty table gives an empty result; columns other than
doc_id and text are not read by ``scan``; ``redact`` keeps all columns of its input.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import free_name, release_memory, ship
from lendnet.llm.words import chunks, text_buffer

DOCS_PER_BLOCK = 1 << 14
MASK = "[REDACTED]"


class Rule(NamedTuple):
    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0          # group whose length is checked
    least: int = 1          # shortest length that counts


RULES: tuple[Rule, ...] = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 18),
    Rule("hex", r"[0-9a-f]+", False, 0, 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{1,64}@"),
)
BASE = ("assign", "access", "hex")


# ---- Boolean trigram queries -------------------------------------------------------------------
# A query is True (no demand), a trigram, or ("and" | "or", frozenset of queries).

def _join(kind: str, parts) -> object:
    flat = set()
    for p in parts:
        if p is True:
            if kind == "or":
                return True
            continue
        flat.update(p[1] if isinstance(p, tuple) and p[0] == kind else [p])
    if not flat:
        return True
    if kind == "or":        # a part that demands all of another part's trigrams adds nothing
        need = {p: p[1] if isinstance(p, tuple) and p[0] == "and" else frozenset([p]) for p in flat}
        flat = {p for p in flat if not any(need[q] < need[p] for q in flat)}
    return next(iter(flat)) if len(flat) == 1 else (kind, frozenset(flat))


def _grams(text: str) -> object:
    return _join("and", [text[i:i + 3] for i in range(len(text) - 2)])


def _strings(options: set[str]) -> object:
    return _join("or", [_grams(s) for s in options]) if options else True


def trigram_query(pattern: str, most: int = 32) -> object:
    """The query every match of ``pattern`` satisfies, from the parsed expression.

    Walking a concatenation keeps the set of literal strings read so far; where it ends (an open
    class, a repeat) or grows past ``most``, its trigrams become a demand and the set starts anew.
    """
    from re import _constants as C
    from re import _parser

    def literals(op, arg) -> set[str] | None:
        if op is C.LITERAL:
            return {chr(arg).lower()}
        if op is C.IN and all(o is C.LITERAL for o, _ in arg):
            return {chr(a).lower() for _, a in arg}
        return None

    def walk(seq) -> tuple[object, set[str] | None]:
        """(demand, exact strings or None if open-ended)."""
        demands, held, closed = [], {""}, True
        for op, arg in seq:
            if op is C.SUBPATTERN:
                need, exact = walk(arg[-1])
            elif op is C.BRANCH:
                parts = [walk(x) for x in arg[1]]
                exact = set().union(*(e for _, e in parts)) if all(e is not None for _, e in parts) else None
                need = _join("or", [_join("and", [d, _strings(e) if e else True]) if e is None else
                                    _join("and", [d, _strings(e)]) for d, e in parts]) if exact is None else True
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, body = arg
                need, exact = walk(body)
                if low == 0 and high == 1 and exact is not None:
                    exact = exact | {""}
                    need = True
                elif low == 0:
                    need, exact = True, None
                elif not (low == high == 1):
                    need, exact = _join("and", [need, _strings(exact) if exact else True]), None
            elif op is C.AT:
                need, exact = True, {""}
            else:
                need, exact = True, literals(op, arg)
            demands.append(need)
            grown = {a + b for a in held for b in exact} if exact is not None else None
            if grown is not None and len(grown) <= most:
                held = grown
            else:
                demands.append(_strings(held))
                held, closed = (exact if exact is not None else {""}), False
        if closed:
            return _join("and", demands), held
        return _join("and", [*demands, _strings(held)]), None

    need, exact = walk(_parser.parse(pattern))
    return _join("and", [need, _strings(exact)]) if exact is not None else need


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(q) for q in query[1]))


# ---- index, candidates, verification -----------------------------------------------------------

def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"))


def _posting_rows(vocabulary: list[str]):
    """(key, trigram) of every wanted trigram in each text; trigrams are ASCII, so bytes decide."""
    def run(batches):
        release_memory()
        code = lambda b: (b[:-2].astype(np.uint32) << 16) | (b[1:-1].astype(np.uint32) << 8) | b[2:]
        wanted = {int(code(np.frombuffer(t.encode(), np.uint8))[0]): t for t in vocabulary}
        slot = np.zeros(1 << 16, bool)              # a first test on a fold of the three bytes
        fold = lambda c: (c ^ (c >> 11)) & 0xFFFF
        codes = np.array(sorted(wanted), np.uint32)
        slot[fold(codes)] = True
        names = np.array([wanted[int(c)] for c in codes], dtype=object)
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            keys = b.column("key").to_numpy()
            for lo, hi in chunks(offsets):
                text = lower[raw[offsets[lo]:offsets[hi]]]
                if len(text) < 3:
                    continue
                c = code(text)
                at = np.flatnonzero(slot[fold(c)])
                i = np.minimum(np.searchsorted(codes, c[at]), len(codes) - 1)
                row = np.searchsorted(offsets[lo:hi + 1] - offsets[lo], at, "right") - 1
                ok = (codes[i] == c[at]) & (at + 3 <= offsets[lo + 1:hi + 1][row] - offsets[lo])
                pair = np.unique(row[ok] * len(codes) + i[ok])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo + pair // len(codes)]), pa.array(names[pair % len(codes)].tolist(), pa.string())],
                    names=["key", "trigram"])
    return run


def build_index(docs: DataFrame, vocabulary: list[str], docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """(block, trigram, postings): sorted keys of the block's documents that contain the trigram."""
    blocks = max(1, -(-docs.count() // docs_per_block))
    return (docs.select(_key().alias("key"), "text").mapInArrow(_posting_rows(vocabulary), "key long, trigram string")
            .groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram")
            .agg(F.sort_array(F.collect_set("key")).alias("postings")))


def _evaluate(query, postings: Column) -> Column:
    none = F.array().cast("array<bigint>")
    if isinstance(query, str):
        return F.coalesce(F.element_at(postings, F.lit(query)), none)
    parts = [_evaluate(q, postings) for q in sorted(query[1], key=str)]
    out = parts[0]
    for p in parts[1:]:
        out = F.array_intersect(out, p) if query[0] == "and" else F.array_union(out, p)
    return out


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(key, kinds): the rules whose Boolean query a document satisfies."""
    by_block = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "postings"))).alias("p"))
    hits = F.array(*[F.struct(F.lit(kind).alias("kind"), _evaluate(q, F.col("p")).alias("keys"))
                     for kind, q in queries.items()])
    return (by_block.select(F.explode(hits).alias("h")).select("h.kind", F.explode("h.keys").alias("key"))
            .groupBy("key").agg(F.collect_set("kind").alias("kinds")))


def _matcher(rules):
    compiled = [(r, re.compile(r.pattern, re.A | (re.I if r.ignore_case else 0))) for r in rules]
    # a run that must reach a length is the same as the run with that length demanded
    compiled = [(r, re.compile(r"[0-9a-f]{%d,}" % r.least) if r.pattern == r"[0-9a-f]+" else p) for r, p in compiled]

    def spans(text: str, wanted) -> list[tuple[int, int, int]]:
        out = []
        for order, (r, p) in enumerate(compiled):
            if wanted is None or r.kind in wanted:
                out += [(m.start(), order, m.end()) for m in p.finditer(text) if m.end(r.group) - m.start(r.group) >= r.least]
        return sorted(out)
    return spans


def _scan_batches(rules, always):
    names = [r.kind for r in rules]

    def run(batches):
        release_memory()
        spans_of = _matcher(rules)
        for b in batches:
            n = {k: [] for k in BASE}
            sha, text_spans = [], []
            for text, kinds in zip(b.column("text").to_pylist(), b.column("kinds").to_pylist()):
                found = spans_of(text, always.union(kinds or ()))
                base = [(s, o, e) for s, o, e in found if names[o] in BASE]
                for k in BASE:
                    n[k].append(sum(names[o] == k for _, o, _ in base))
                sha.append(hashlib.sha256(",".join(f"{names[o]}:{s}:{e}" for s, o, e in base).encode()).hexdigest())
                text_spans.append(",".join(f"{names[o]}:{s}:{e}" for s, o, e in found))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(n[k], pa.int64()) for k in BASE), pa.array(sha, pa.string()),
                 pa.array(text_spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def _with_kinds(docs: DataFrame, rules, name: str) -> tuple[DataFrame, frozenset]:
    """``docs`` plus a column ``name`` (candidate rules of the row), and the rules that scan every row."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    always = frozenset(k for k, q in queries.items() if q is True)
    asked = {k: q for k, q in queries.items() if q is not True}
    if not asked:
        return docs.withColumn(name, F.lit(None).cast("array<string>")), always
    vocabulary = sorted(set().union(*(trigrams_of(q) for q in asked.values())))
    key = free_name(docs, "secret_key")
    found = candidates(build_index(docs.select("doc_id", "text"), vocabulary), asked)
    return docs.withColumn(key, _key()).join(found.select(F.col("key").alias(key), F.col("kinds").alias(name)),
                                             key, "left").drop(key), always


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans ('kind:start:end', comma-joined)."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, always = _with_kinds(src, rules, "kinds")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "kinds").mapInArrow(
        _scan_batches(rules, always),
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _redact_batches(rules, always, mask, name):
    def run(batches):
        release_memory()
        spans_of = _matcher(rules)
        for b in batches:
            out = []
            for text, kinds in zip(b.column("text").to_pylist(), b.column(name).to_pylist()):
                found = spans_of(text, always.union(kinds or ())) if text else []
                at, parts = 0, []
                for s, _, e in found:
                    if s >= at:
                        parts += [text[at:s], mask]
                    at = max(at, e)
                out.append("".join(parts) + text[at:] if found else text)
            i = b.schema.get_field_index("text")
            done = b.set_column(i, "text", pa.array(out, pa.string()))
            yield done.drop_columns([name])
    return run


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = MASK) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mask`` (overlapping spans by one)."""
    ship(docs.sparkSession)
    src, name = docs.withColumn("text", F.col("text").cast("string")), free_name(docs, "secret_kinds")
    rows, always = _with_kinds(src, rules, name)
    return rows.mapInArrow(_redact_batches(rules, always, mask, name), src.schema)
