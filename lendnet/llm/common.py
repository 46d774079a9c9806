"""Shared helpers of the training-data operators: shared tables, code shipping, column hygiene."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendnet.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (what --py-files does)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="lendnet-py-"), "lendnet_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(os.path.join(root, "lendnet")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def release_memory() -> None:
    """Give memory that earlier tasks of this Python worker freed back to the system; the worker keeps living between
    stages, and the allocators keep what they once took."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session's settings are ``values`` for what is planned within, and what they were afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the session's reliable checkpoint folder (shared on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: a lineage cut whose
    rows no longer depend on how an executor's retry would order or split them."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns of ``docs`` plus ``text`` (null text read as empty); other columns go."""
    keep = [F.col(c) for c in cols]
    return docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold_remainder(col, n: int = 5):
    """crc32 of the id as text, modulo ``n``: the documented held-out fold is remainder 0."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n if isinstance(col, str) else F.crc32(col) % n


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
