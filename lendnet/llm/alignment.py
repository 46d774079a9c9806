"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Both tokenizers cover the same bytes (a blank and the text). A byte offset where a token of A and a token of B end
is a shared cut; between neighbouring cuts lies one leaf group. An interval between two known cuts is divided near
its middle: A's middle end is looked up among B's ends by bisection, then its neighbours on either side, until the
nearest shared cut on each side is found. What lies between those two is a leaf group (nothing in it is shared);
the intervals left and right of it are divided in turn. Every inner end is probed once, so n tokens take O(n log n).
All open intervals of a batch of texts take their step together (one ``searchsorted`` per step).

Linked are the A and B tokens whose byte ranges overlap: each stretch between neighbouring ends of either side lies
in one token of A and one of B. Statistics of linked id pairs cover the corpus: tasks write blocks of documents
with a dictionary of the block's id pairs (``BLOCK_LINKS`` links a block, more where one document is longer); the
dictionaries, not the links, are summed by pair, compared by B id and sent back to their blocks.

A single blank between two other characters is safe: both tokenizers always cut before it (no piece of either
vocabulary holds a blank behind another character), and the ids on its two sides do not depend on each other. So a
worker tokenizes each distinct unit between safe blanks once, and texts are aligned in chunks that end at one.

Cases: a null or empty text, or one whose token bytes differ from blank + text on either side, has no tokens and
gets zeros; strings of special tokens are plain text; null ids and repeated rows stay rows of their own; an empty
table gives an empty table; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.llm.common import release_memory, settings, ship, stored
from lendnet.llm.tokens import WHITE, _byte_letters

SEGMENT = 1 << 16           # characters of a text's segment
CHUNK = 1 << 18             # characters of texts that are aligned at once
BLOCK_LINKS = 1 << 20       # links of a block of documents
MAX_UNITS = 100_000         # entries of a worker's young generation of encoded units (the old one is as large)
LEARN = 1 << 12             # units that go to the tokenizers at once
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}
SAFE = re.compile(r"(?<=\S) (?=\S)")
ODD = ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r")         # with these a plain split at blanks is not safe
RARE = re.compile(f"[{WHITE[4:]}]")                            # nor beside white space outside ASCII


class _Side(NamedTuple):
    encode: object           # list of units -> list of id lists
    table: list              # id -> bytes
    size: np.ndarray         # id -> number of bytes


def _byte_level(path: str) -> _Side:
    """A byte-level vocabulary of the ``tokenizers`` library; a unit is encoded behind a blank."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    code = {c: b for b, c in _byte_letters().items()}
    table = [b""] * tok.get_vocab_size()
    for token, i in tok.get_vocab().items():
        table[i] = bytes(code[c] for c in token) if all(c in code for c in token) else token.encode()
    return _Side(lambda units: [e.ids for e in tok.encode_batch_fast([" " + u for u in units], add_special_tokens=False)],
                 table, np.array([len(x) for x in table], np.int64))


def _piece_level(path: str) -> _Side:
    """A sentencepiece model, which puts the blank before a unit itself."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())
    return _Side(lambda units: sp.encode(units, num_threads=1), table, np.array([len(x) for x in table], np.int64))


def segments(text: str, size: int | None = None) -> list[str]:
    """``text`` cut at safe blanks into parts of about ``size`` characters (the blanks at the cuts go)."""
    size = size or SEGMENT
    out, at = [], 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.end()
    out.append(text[at:])
    return out


def units(text: str) -> list[str]:
    """``text`` cut at every safe blank."""
    if any(x in text for x in ODD) or text[:1] == " " or text[-1:] == " " or not text.isascii() and RARE.search(text):
        return SAFE.split(text)
    return text.split(" ")


def _same_bytes(side: _Side, flat: np.ndarray, size: np.ndarray, want: list[bytes]) -> np.ndarray:
    """Whether the ids of each unit (``size`` of ``flat``) have the bytes ``want``: all units at once, one by one only
    where something differs."""
    pieces = list(map(side.table.__getitem__, flat.tolist()))
    stop = size.cumsum()
    ends = np.concatenate([[0], side.size[flat].cumsum()])[stop]
    if np.array_equal(ends, np.fromiter(map(len, want), np.int64, len(want)).cumsum()) and b"".join(pieces) == b"".join(want):
        return np.ones(len(want), bool)
    cut = [0, *stop.tolist()]
    return np.array([b"".join(pieces[s:e]) == w for s, e, w in zip(cut, cut[1:], want)])


class _Known:
    """A generation of encoded units: the place of each, and the ids of all places in one array a side. Place 0 has
    no ids: its units' bytes do not come back."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids = array("I"), array("I")
        self.ends = array("q", [0, 0]), array("q", [0, 0])

    def add(self, new: list[str], good: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``new`` units with (ids, ids of each unit) a side; only the ``good`` ones get a place of their own."""
        at = np.where(good, len(self.ends[0]) - 2 + good.cumsum(), 0)
        for flat, ends, (ids, size) in zip(self.ids, self.ends, sides):
            ends.frombytes((len(flat) + size[good].cumsum()).astype(np.int64).tobytes())
            flat.frombytes((ids if good.all() else ids[np.repeat(good, size)]).astype(np.uint32).tobytes())
        self.place.update(zip(new, at.tolist()))

    def take(self, at: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids at these places, and how many each place has."""
        ends = np.frombuffer(self.ends[side], np.int64)
        start, size = ends[at], ends[at + 1] - ends[at]
        stop = size.cumsum()
        take = np.repeat(start - stop + size, size)
        take += np.arange(len(take))
        return np.frombuffer(self.ids[side], np.uint32)[take], size


class _Tokens:
    """Token ids of segments on both sides; each distinct unit between safe blanks is encoded once."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ((_byte_level if p.endswith(".json") else _piece_level)(p) for p in (path_a, path_b))
        self.known, self.old = _Known(), _Known()

    def _learn(self, new: list[str]) -> None:
        again = [u for u in new if u in self.old.place]
        if again:
            at = np.array(list(map(self.old.place.__getitem__, again)), np.int64)
            self.known.add(again, at > 0, [self.old.take(at, 0), self.old.take(at, 1)])
            new = [u for u in new if u not in self.old.place]
        for lo in range(0, len(new), LEARN):
            part = new[lo:lo + LEARN]
            want = [b" " + u.encode() for u in part]
            sides, good = [], np.ones(len(part), bool)
            for side in (self.a, self.b):
                ids = side.encode(part)
                flat = np.fromiter(chain.from_iterable(ids), np.uint32)
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                good &= _same_bytes(side, flat, size, want)
                sides.append((flat, size))
            self.known.add(part, good, sides)

    def encode(self, segs: list[str]) -> list[tuple[bytes, bytes] | None]:
        """(A's ids, B's ids) of each segment as 32-bit integers; None where the bytes do not come back."""
        if len(self.known.place) > MAX_UNITS:
            self.old, self.known = self.known, _Known()
        cut = [units(s) for s in segs]
        new = list(set(chain.from_iterable(cut)) - self.known.place.keys())
        if new:
            self._learn(new)
        if not cut:
            return []
        at = np.fromiter(map(self.known.place.__getitem__, chain.from_iterable(cut)), np.int64)
        stop = np.fromiter(map(len, cut), np.int64, len(cut)).cumsum()
        first = np.concatenate([[0], stop[:-1]])
        bad = np.minimum.reduceat(at, first) == 0
        sides = []
        for side in (0, 1):
            ids, size = self.known.take(at, side)
            ends = [0, *size.cumsum()[stop - 1].tolist()]
            sides.append([ids[s:e].tobytes() for s, e in zip(ends, ends[1:])])
        return [None if x else (a, b) for x, a, b in zip(bad.tolist(), *sides)]


def _tokens(path_a: str, path_b: str) -> _Tokens:
    """The worker's tokenizers: kept for as long as the Python worker lives."""
    kept = sys.modules[__name__].__dict__.setdefault("_kept", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = _Tokens(path_a, path_b)
    return kept[path_a, path_b]


def divide(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A's token numbers whose ends are shared cuts, in order.

    ``first`` and ``last`` bound the open intervals of A's tokens; the end of every ``last`` is shared."""
    def shared(tokens: np.ndarray) -> np.ndarray:
        at = np.searchsorted(ends_b, ends_a[tokens])
        return ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[tokens]

    cuts = [last]
    lo, hi = first, last                       # tokens lo .. hi, the end of hi is a cut
    while len(lo):
        mid = (lo + hi) // 2
        right, seek = mid.copy(), np.flatnonzero(mid < hi)
        while len(seek):                       # the nearest cut from the middle on
            seek = seek[~shared(right[seek])]
            right[seek] += 1
            seek = seek[right[seek] < hi[seek]]
        left = mid - 1
        seek = np.flatnonzero(left >= lo)
        while len(seek):                       # the nearest cut before the middle (lo - 1: the interval's border)
            seek = seek[~shared(left[seek])]
            left[seek] -= 1
            seek = seek[left[seek] >= lo[seek]]
        cuts += [right[right < hi], left[left >= lo]]
        # tokens left + 1 .. right are a leaf group
        lo, hi = (np.concatenate([lo[left >= lo], right[right < hi] + 1]),
                  np.concatenate([left[left >= lo], hi[right < hi]]))
    return np.sort(np.concatenate(cuts))


class Aligned(NamedTuple):
    rows: np.ndarray         # document (row of the group) of each segment
    a: np.ndarray            # token ids of all segments
    b: np.ndarray
    ends_a: np.ndarray       # byte ends on the axis of all segments
    ends_b: np.ndarray
    seg_a: np.ndarray        # tokens of segment s: seg_a[s] .. seg_a[s + 1]
    seg_b: np.ndarray
    cut_a: np.ndarray        # last token of A of each group
    cut_b: np.ndarray


def align(rows: list[int], encoded: list[tuple[bytes, bytes]], tok: _Tokens) -> Aligned:
    """Align segments; ``rows`` names the document of each."""
    na, nb = (np.array([0] + [len(e[c]) // 4 for e in encoded], np.int64).cumsum() for c in (0, 1))
    a, b = (np.frombuffer(b"".join([e[c] for e in encoded]), np.uint32).astype(np.int64) for c in (0, 1))
    ends_a, ends_b = tok.a.size[a].cumsum(), tok.b.size[b].cumsum()
    cut_a = divide(ends_a, ends_b, na[:-1], na[1:] - 1) if len(rows) else np.zeros(0, np.int64)
    return Aligned(np.array(rows, np.int64), a, b, ends_a, ends_b, na, nb, cut_a,
                   np.searchsorted(ends_b, ends_a[cut_a]) if len(rows) else cut_a)


def _links(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token) of every link, in byte order, and the number of links before each segment."""
    size = int(x.ends_a[-1]) + 1 if len(x.ends_a) else 1
    mark_a, mark_b = np.zeros(size, np.int32), np.zeros(size, np.int32)
    mark_a[x.ends_a] = mark_b[x.ends_b] = 1
    ends = np.flatnonzero(mark_a | mark_b)
    # a stretch that ends at byte e lies in the token behind the ends below e
    at, bt = ((m.cumsum() - m)[ends] for m in (mark_a, mark_b))
    return at, bt, np.searchsorted(at, x.seg_a)


def _groups_of(batch: pa.RecordBatch, tok: _Tokens) -> Iterator[tuple[int, int, list]]:
    """(lo, hi, chunks) for row ranges of about ``CHUNK`` characters (or one longer text): chunks are the (rows,
    encoded segments) to align at once. Documents whose bytes do not come back, and empty ones, have no segment."""
    col, lo = batch.column("text"), 0
    while lo < batch.num_rows:
        rows, segs, hi, held = [], [], lo, 0
        while hi < batch.num_rows and held < CHUNK:
            text = col[hi].as_py() or ""
            parts = segments(text) if text else []
            rows += [hi - lo] * len(parts)
            segs += parts
            held += len(text)
            hi += 1
        at, encoded = 0, []
        while at < len(segs):                      # a long text's segments go to the tokenizers part by part
            encoded += tok.encode(segs[at:at + max(1, CHUNK // SEGMENT)] if held > 4 * CHUNK else segs[at:])
            at = len(encoded)
        bad = {r for r, e in zip(rows, encoded) if e is None}
        good = [(r, e, len(s)) for r, e, s in zip(rows, encoded, segs) if r not in bad]
        chunks, size = [([], [])], 0
        for r, e, n in good:
            if size >= CHUNK:
                chunks.append(([], []))
                size = 0
            chunks[-1][0].append(r)
            chunks[-1][1].append(e)
            size += n
        yield lo, hi, chunks
        lo = hi


class _Printer:
    """Group texts ``a1,a2|b1;a3|b2,b3``: one lookup per token, then a join."""

    def __init__(self, tok: _Tokens):
        self.base, n = len(tok.a.table), len(tok.b.table)
        self.size = self.base + n
        ids = [b"%d" % i for i in chain(range(self.base), range(n))]
        ends = [b"|"] * self.base + [b";"] * n
        self.words = np.array([x + b"," for x in ids] + [x + e for x, e in zip(ids, ends)], object)

    def order(self, x: Aligned) -> np.ndarray:
        """Word numbers of all tokens, group by group, A's before B's."""
        last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        last_a[x.cut_a] = last_b[x.cut_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], x.cut_b + 1])
        out = np.empty(len(x.a) + len(x.b), np.int64)
        out[np.arange(len(x.a)) + before_b[group_a]] = x.a + last_a * self.size
        out[np.arange(len(x.b)) + x.cut_a[group_b] + 1] = x.b + self.base + last_b * self.size
        return out


def _blocks(path_a: str, path_b: str):
    def run(batches):
        tok = _tokens(path_a, path_b)
        printer = _Printer(tok)
        part, number, kind = TaskContext.get().partitionId(), 0, pa.int64()
        ids, stats, hashes, keys, held = [], [], [], [], 0

        def flush():
            index, pair = pd.factorize(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            n = np.bincount(index, minlength=len(pair))
            by_count = np.argsort(-n, kind="stable")       # frequent pairs get small numbers, which compress well
            rank = np.empty(len(pair), "<u4")
            rank[by_count] = np.arange(len(pair), dtype="<u4")
            pair, n = pair[by_count], n[by_count]
            stat = np.concatenate(stats)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([list(chain.from_iterable(ids))], pa.list_(kind)),
                 *(pa.array([stat[:, c]], pa.list_(pa.int64())) for c in range(4)), pa.array([hashes]),
                 pa.array([pair >> 32], pa.list_(pa.int32())), pa.array([pair & 0xFFFFFFFF], pa.list_(pa.int32())),
                 pa.array([n], pa.list_(pa.int64())), pa.array([rank[index].tobytes()], pa.binary())],
                names=["block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "hashes",
                       "pair_a", "pair_b", "pair_n", "links"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for lo, hi, chunks in _groups_of(batch, tok):
                own = np.zeros((hi - lo, 4), np.int64)
                digest = [None] * (hi - lo)
                for rows, encoded in chunks:
                    x = align(rows, encoded, tok)
                    at, bt, seg = _links(x)
                    np.add.at(own, x.rows, np.stack(
                        [np.diff(x.seg_a), np.diff(x.seg_b), np.diff(np.searchsorted(x.cut_a, x.seg_a)), np.diff(seg)],
                        axis=1))
                    words = printer.order(x)
                    border = x.seg_a + x.seg_b
                    held_rows, first = np.unique(x.rows, return_index=True)
                    for i, s, e in zip(held_rows.tolist(), border[first], border[np.append(first[1:], len(x.rows))]):
                        text = b"".join(printer.words[words[s:e]].tolist())[:-1]
                        if digest[i] is None:
                            digest[i] = hashlib.sha256(text)
                        else:
                            digest[i].update(b";" + text)
                    keys.append((x.a[at] << 32) + x.b[bt])
                    held += len(at)
                hashes += [d.hexdigest() if d else "" for d in digest]
                ids.append(batch.column("doc_id").slice(lo, hi - lo).to_pylist())
                stats.append(own)
                if held >= BLOCK_LINKS:
                    yield flush()
                    ids, stats, hashes, keys, held = [], [], [], [], 0
                    number += 1
                    release_memory()
        if ids:
            yield flush()
    return run


def _groups(path_a: str, path_b: str):
    def run(batches):
        tok = _tokens(path_a, path_b)
        for batch in batches:
            for lo, hi, chunks in _groups_of(batch, tok):
                x = align([r for rows, _ in chunks for r in rows], [e for _, enc in chunks for e in enc], tok)
                first = np.searchsorted(x.rows, np.arange(hi - lo + 1))
                origin = np.concatenate([[0], x.ends_a])[x.seg_a[first]]       # byte 0 of each document
                groups = np.searchsorted(x.cut_a, x.seg_a[first])
                ends = x.ends_a[x.cut_a] if len(x.cut_a) else x.cut_a
                row = np.repeat(np.arange(hi - lo), np.diff(groups))
                start = np.concatenate([[0], ends])[:len(ends)] - origin[row]

                def lists(ids, cuts):
                    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], cuts + 1]), pa.int32()),
                                                    pa.array(ids, pa.int32()))
                fields = pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(ends - origin[row]), lists(x.a, x.cut_a), lists(x.b, x.cut_b)],
                    ["start", "end", "a_ids", "b_ids"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(groups, pa.int32()), fields)], names=["doc_id", "groups"])
    return run


def token_groups(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """doc_id and its groups: start, end (bytes of blank + text, end exclusive), a_ids, b_ids."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_groups(file_a, file_b), f"doc_id {kind}, groups array<struct<start:long,`end`:long,"
                                                   "a_ids:array<int>,b_ids:array<int>>>")


def aligned_blocks(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Stored blocks of aligned documents: per document its counts and the hash of its groups, the block's
    dictionary of id pairs with their links, and the links as numbers of that dictionary."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    longs = ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    with settings(docs.sparkSession, BATCH):       # texts wait in an executor's and a worker's memory by the batch
        return stored(src.mapInArrow(
            _blocks(file_a, file_b), f"block long, doc_ids array<{kind}>, {longs}, hashes array<string>, "
            "pair_a array<int>, pair_b array<int>, pair_n array<long>, links binary"), "aligned")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """One row per block and id pair: block, pos (number in the block's dictionary), a, b, n."""
    return (blocks.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("pos", "p"))
            .select("block", "pos", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"),
                    F.col("p.pair_n").alias("n")))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, links over the corpus, and whether no other partner of ``b`` has more (ties: all of them).
    A window sees the distinct partners of one id, at most A's vocabulary."""
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("links"))
    return total.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def _report(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Per document sums of one block from the corpus-wide counts of its dictionary."""
    pos = answers.column("pos").to_numpy()
    links, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    links[pos] = answers.column("links").to_numpy()
    best[pos] = answers.column("best").combine_chunks().cast(pa.int64()).to_numpy(zero_copy_only=False)
    index = np.frombuffer(blocks.column("links")[0].as_py(), "<u4")

    def col(name):
        return blocks.column(name).combine_chunks().values
    cut = np.concatenate([[0], np.cumsum(col("n_links").to_numpy())])
    sums = [np.concatenate([[0], np.cumsum(x[index])]) for x in (best, links)]
    n_best, count_sum = (s[cut[1:]] - s[cut[:-1]] for s in sums)
    return pa.table({"doc_id": col("doc_ids"), **{c: col(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
                     "n_best": n_best, "count_sum": count_sum, "groups_sha256": col("hashes")})


def alignment_report(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    blocks = aligned_blocks(docs, file_a, file_b)
    pairs = block_pairs(blocks)
    answers = pairs.join(pair_counts(pairs), ["a", "b"]).select("block", "pos", "links", "best")
    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    home = blocks.drop("pair_a", "pair_b", "pair_n").withColumnRenamed("block", "home")
    sides = home.groupBy("home").cogroup(answers.groupBy("block"))
    return sides.applyInArrow(_report, f"doc_id {kind}, {longs}, groups_sha256 string")
