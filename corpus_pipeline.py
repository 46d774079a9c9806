"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's ``docs``. All stages but the last return the columns of ``documents``:

* toxicity: documents the factorization machine predicts toxic go;
* near_dedup: of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays;
* decontamination: documents that hold a passage of a benchmark item go;
* secret_scan: found secrets are masked in ``text`` (``n_chars`` follows); no document goes;
* packing: the remaining documents become pieces of 1024-token sequences.

SQL cannot state the learned, signature and alignment steps, so ``ORACLE_SQL`` is None and the stages are
tested against brute-force versions. An empty table runs through to an empty result; null texts pass
the filters (they match nothing) and are packed as their end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendnet.llm.common import stored, table
from lendnet.llm.decontam import decontaminate
from lendnet.llm.neardup import deduplicate
from lendnet.llm.packing import pack
from lendnet.llm.queries import tokenizer_file
from lendnet.llm.secrets import redact
from lendnet.llm.toxicity import reject


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, k=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = redact(docs)
    if "n_chars" not in out.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the packing stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
