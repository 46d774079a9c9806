"""Packing: concatenate and cut.

Pass 1 tokenizes each document once and writes (partition, start inside the partition, ids) to the shared
folder; partition totals then give every partition its global offset (one row per partition). Pass 2
lays fixed windows over the global positions: a document becomes one piece per window it touches, and
the pieces at either end are the boundary records that share a window with a neighbour document or
partition. Every window but the last is full, so at most one sequence is padded.

Cases: null or empty text is the end id alone; repeated rows are packed once per row; a text of any
length is cut into windows; an empty table gives no pieces; only doc_id and text are read, so extra or
clashing columns do not matter. Positions follow the order in which pass 1 wrote the rows: a retry of
a later task reads the same stored positions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.llm.common import release_memory, ship, stored
from lendnet.llm.tokens import encoder, groups

SEQUENCE = 1024
END_ID = 0


def _tokenize(path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        release_memory()
        enc = encoder(path)
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ids_col, text_col = b.column("doc_id"), b.column("text")
            texts = text_col.to_pylist()
            for lo, hi in groups(texts):
                ids = [np.frombuffer(x + end, "<u4").astype("<u2" if enc.tok.get_vocab_size() <= 1 << 16 else "<u4")
                       for x in enc.encode(texts[lo:hi])]
                n = np.array([len(x) for x in ids], np.int64)
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [ids_col.slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)), pa.array(start),
                     pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"])
    return run


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Stored table doc_id, part, part_start, n_tokens, ids (16- or 32-bit little-endian)."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(src.mapInArrow(
        _tokenize(tokenizer, end_id), f"doc_id {kind}, part int, part_start long, n_tokens long, ids binary"), "tokens")


def with_offsets(tokens: DataFrame, part: str = "part", start: str = "part_start", n: str = "n_tokens") -> DataFrame:
    """Add ``at``: the global position of a row, from the totals of the partitions before its own.

    The totals hold one row per written partition, which is what the one-partition window and the
    broadcast see.
    """
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = tokens.groupBy(part).agg(F.sum(n).alias("_n"))
    offsets = totals.select(part, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return tokens.join(F.broadcast(offsets), part).withColumn("at", F.col("_off") + F.col(start)).drop("_off")


def _cut(size: int, with_ids: bool):
    def run(batches):
        release_memory()
        for b in batches:
            n = np.asarray(b.column("n_tokens"))
            at = np.asarray(b.column("at"))
            first = at // size
            count = (at + n - 1) // size - first + 1
            row = np.repeat(np.arange(b.num_rows), count)
            k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            seq = first[row] + k
            lo = np.maximum(seq * size, at[row])
            hi = np.minimum((seq + 1) * size, at[row] + n[row])
            start = lo - at[row]
            data = b.column("ids")
            crc = np.zeros(len(row), np.int64)
            out: list = []
            i = 0
            for r in range(b.num_rows):
                raw = data[r].as_py()
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n[r] else "<u4").astype("<u4")
                for j in range(i, i + count[r]):
                    piece = ids[start[j]:start[j] + hi[j] - lo[j]]
                    crc[j] = zlib.crc32(piece.tobytes())
                    if with_ids:
                        out.append(piece.astype(np.int32))
                i += count[r]
            cols = [b.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(hi - lo), pa.array(crc),
                    pa.array(n[row]), pa.array(seq), pa.array(lo - seq * size)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array(out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    placed = with_offsets(tokenized(docs, tokenizer, end_id))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "`offset` long") + (", ids array<int>" if with_ids else "")
    return placed.select("doc_id", "n_tokens", "at", "ids").mapInArrow(_cut(size, with_ids), schema)


def sequences(pieces: DataFrame, size: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """Training rows from pieces with ids: sequence_id, input_ids (padded to ``size`` unless the length
    is a power of two) and the pieces' (doc_id, start, length). A group holds at most ``size`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "start", "doc_id", "ids")))
    g = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    n = F.size("ids")
    pad = F.when(F.expr("size(ids) & (size(ids) - 1)") == 0, F.lit(0)).otherwise(F.lit(size) - n)
    return (g.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: F.struct(
        x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length"))).alias("pieces"))
        .select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("input_ids"),
                n.alias("length"), "pieces"))
