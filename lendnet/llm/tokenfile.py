"""Token-id files: patched frame-of-reference blocks.

Documents are range-partitioned by id (ties by a hash of the text), tokenized in order and written as
segments. A segment row holds the ids of whole documents (about ``SEGMENT`` ids, more where one document
is longer) and its directory (ids and lengths). Its payload is:

    magic 'PFOR', count of ids (u32), count of blocks (u32),
    block index: per block of 128 ids: minimum u32, width u8, exceptions u8, start of the packed bits u32,
                 start of the exceptions u32,
    packed bits (little-endian, width bits an id), exception positions (u8), exception high parts (u32)

The width of a block is that of its 90th percentile above the minimum; ids that need more keep their
low bits in place and their high part in the exception list. The index makes any block readable alone.

Cases: null or empty text is the end id alone; null doc_ids sort first; repeated rows are all written;
an empty table writes no segment; extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import shared_path, ship
from lendnet.llm.packing import with_offsets
from lendnet.llm.tokens import encoder, groups

BLOCK = 128
SEGMENT = 1 << 16
PERCENTILE = 0.9
INDEX = np.dtype([("min", "<u4"), ("width", "u1"), ("exc", "u1"), ("packed", "<u4"), ("patch", "<u4")])


def encode_segment(ids: np.ndarray) -> bytes:
    """PFOR payload of unsigned 32-bit ids."""
    n = len(ids)
    nb = -(-n // BLOCK)
    v = np.zeros(nb * BLOCK, np.int64)
    v[:n] = ids
    if n:
        v[n:] = ids[-1]
    v = v.reshape(nb, BLOCK)
    index = np.zeros(nb, INDEX)
    index["min"] = v.min(axis=1) if nb else 0
    d = v - index["min"].astype(np.int64)[:, None]
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    ranked = np.partition(d, rank, axis=1)[:, rank]
    width = np.frexp(ranked.astype(float))[1].astype(np.int64)       # bits of the percentile value
    index["width"] = width
    high = d >> width[:, None]
    patched = high > 0
    index["exc"] = patched.sum(axis=1)
    index["packed"] = np.cumsum(width * BLOCK // 8) - width * BLOCK // 8
    index["patch"] = np.cumsum(index["exc"]) - index["exc"]
    packed = np.zeros(int((width * BLOCK // 8).sum()), np.uint8)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        kind = "<u2" if w <= 16 else "<u4"
        raw = (d[at] & ((1 << int(w)) - 1)).astype(kind).view(np.uint8).reshape(len(at), BLOCK, -1)
        bits = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :w].reshape(len(at), -1)
        cells = index["packed"][at].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)
        packed[cells] = np.packbits(bits, axis=1, bitorder="little")
    blocks, pos = np.nonzero(patched)
    return b"".join((b"PFOR", np.array([n, nb], "<u4").tobytes(), index.tobytes(), packed.tobytes(),
                     pos.astype("u1").tobytes(), high[blocks, pos].astype("<u4").tobytes()))


def decode_segment(raw: bytes) -> np.ndarray:
    """The ids of a payload of ``encode_segment``."""
    if raw[:4] != b"PFOR":
        raise ValueError("not a PFOR segment")
    n, nb = (int(x) for x in np.frombuffer(raw, "<u4", 2, 4))
    index = np.frombuffer(raw, INDEX, nb, 12)
    at = 12 + nb * INDEX.itemsize
    width = index["width"].astype(np.int64)
    size = int((width * BLOCK // 8).sum())
    packed = np.frombuffer(raw, np.uint8, size, at)
    exc = int(index["exc"].astype(np.int64).sum())
    pos = np.frombuffer(raw, np.uint8, exc, at + size).astype(np.int64)
    high = np.frombuffer(raw, "<u4", exc, at + size + exc).astype(np.int64)
    d = np.zeros((nb, BLOCK), np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        cells = index["packed"][rows].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)
        raw = np.zeros((len(rows), w * BLOCK // 8 + 4), np.uint32 if w <= 16 else np.uint64)
        raw[:, :-4] = packed[cells]
        bit = np.arange(BLOCK) * int(w)
        value = raw[:, bit >> 3]
        for k in range(1, 3 if w <= 16 else 5):      # the bytes that a value of this width can touch
            value |= raw[:, (bit >> 3) + k] << raw.dtype.type(8 * k)
        d[rows] = (value >> (bit & 7).astype(raw.dtype)) & raw.dtype.type((1 << int(w)) - 1)
    block = np.repeat(np.arange(nb), index["exc"])
    d[block, pos] |= high << width[block]
    return (d + index["min"].astype(np.int64)[:, None]).reshape(-1)[:n].astype("<u4")


def _write(path: str, end_id: int):
    def run(batches):
        enc = encoder(path)
        shard = TaskContext.get().partitionId()
        number = at = held = 0
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids, ids = [], []

        def flush():
            flat = np.frombuffer(b"".join(ids), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([at], pa.int64()),
                 pa.array([len(flat)], pa.int64()), pa.array([doc_ids], pa.list_(kind)),
                 pa.array([[len(x) // 4 for x in ids]], pa.list_(pa.int32())),
                 pa.array([encode_segment(flat)], pa.binary())],
                names=["shard", "segment", "shard_start", "n_ids", "doc_ids", "doc_lens", "payload"])
        kind = None
        for b in batches:
            kind = b.schema.field("doc_id").type
            keys, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for lo, hi in groups(texts):
                for key, raw in zip(keys[lo:hi], enc.encode(texts[lo:hi])):
                    doc_ids.append(key)
                    ids.append(raw + end)
                    held += len(raw) // 4 + 1
                    if held >= SEGMENT:
                        yield flush()
                        number, at, held = number + 1, at + held, 0
                        doc_ids.clear()
                        ids.clear()
        if ids:
            yield flush()
    return run


def write_files(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Write the ids of all documents, in ascending doc_id order, as PFOR segments under ``path``."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("_h", F.xxhash64("text"))
    ordered = src.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    (ordered.mapInArrow(_write(tokenizer, end_id), "shard int, segment int, shard_start long, n_ids long, "
                        f"doc_ids array<{kind}>, doc_lens array<int>, payload binary")
     .write.option("compression", "none").parquet(path))


def _read(batches):
    for b in batches:
        for i in range(b.num_rows):
            ids = decode_segment(b.column("payload")[i].as_py())
            lens = np.array(b.column("doc_lens")[i].as_py(), np.int64)
            cuts = np.concatenate([[0], np.cumsum(lens)])
            crc = [zlib.crc32(ids[cuts[k]:cuts[k + 1]].tobytes()) for k in range(len(lens))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_ids")[i].values, pa.array(b.column("at")[i].as_py() + cuts[:-1]), pa.array(lens),
                 pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_files(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    ship(spark)
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    # shards are few and their totals come from the small columns alone
    placed = with_offsets(segments, "shard", "shard_start", "n_ids")
    return placed.select("at", "doc_ids", "doc_lens", "payload").mapInArrow(
        _read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files to the shared folder and report what they hold."""
    path = shared_path(docs.sparkSession, "pfor")
    write_files(docs, tokenizer, end_id, path)
    return read_files(docs.sparkSession, path)
