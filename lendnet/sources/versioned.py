"""Versioned tables: key-bucketed upserts behind an atomic pointer.

Below the table's folder:

* ``data/<version>-<id>/_bucket=<b>/``: the rows of the buckets a commit touched (whole buckets, Parquet);
* ``manifest/<version>.json``: where each bucket's current rows lie, the schema, the high-water mark and the last
  batch id of every writer;
* ``_current``: the number of the version that readers see.

A commit writes its data, then its manifest, then replaces the pointer by one rename, so a reader sees the version
before or after it and nothing between. A run that stops before the rename leaves files that no version names; the
same batch is then written again under a new name. A batch id that a writer has committed is not applied again.
Only buckets that receive rows are read and rewritten; the mark is kept in the manifest, so finding new rows reads
nothing of the table. One writer at a time: a commit whose parent is no longer current raises.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

BUCKETS = 16
POINTER = "_current"
BUCKET = "_bucket"


class Commit(NamedTuple):
    version: int
    applied: bool                # False: this batch id was committed before
    touched: list                # buckets that were rewritten
    late: DataFrame | None       # rows at or below the mark whose key the table does not hold


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, writer: str = "default"):
        self.spark, self.path, self.writer = spark, path.rstrip("/"), writer
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    # ------------------------------------------------------------------ small files

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _get(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def _put(self, name: str, text: str, overwrite: bool = False) -> None:
        stream = self._fs.create(self._at(name), overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _names(self, folder: str = "") -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    # ------------------------------------------------------------------ versions

    def version(self) -> int | None:
        """The version that readers see; None where there is no table yet."""
        if self._fs.exists(self._at(POINTER)):
            return int(self._get(POINTER))
        foreign = [n for n in self._names() if n not in ("data", "manifest") and not n.startswith(POINTER)]
        if foreign:
            raise ValueError(f"{self.path} holds files of something else: {sorted(foreign)[:3]}")
        return None

    def manifest(self, version: int | None = None) -> dict | None:
        v = self.version() if version is None else version
        return None if v is None else json.loads(self._get(f"manifest/{v}.json"))

    def _swap(self, version: int) -> None:
        """Make ``version`` current: one rename over the pointer."""
        tmp = f"{POINTER}.{uuid.uuid4().hex}"
        self._put(tmp, str(version))
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at().toUri(), self._conf)
        context.rename(self._fs.makeQualified(self._at(tmp)), self._fs.makeQualified(self._at(POINTER)), how)

    def _commit(self, parent: dict | None, changes: dict) -> int:
        base = parent["version"] if parent else -1
        if (self.version() if parent else None) != (parent["version"] if parent else None):
            raise RuntimeError(f"{self.path}: version {base} is no longer current")
        # numbers of runs that stopped before the pointer are passed over
        version = max([base, *(int(n.split(".")[0]) for n in self._names("manifest") if n.endswith(".json"))]) + 1
        self._put(f"manifest/{version}.json", json.dumps({**(parent or {}), **changes, "version": version, "parent": base}))
        self._swap(version)
        return version

    # ------------------------------------------------------------------ reading

    def _rows(self, manifest: dict, buckets=None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        files = [f"{self.path}/{p}" for b, p in sorted(manifest["files"].items())
                 if buckets is None or int(b) in buckets]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if m is None:
            raise ValueError(f"no table at {self.path}")
        return self._rows(m)

    # ------------------------------------------------------------------ writing

    def _bucket(self, keys: list[str], n: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")

    def _mark(self, manifest: dict | None, batch: DataFrame, ts: str) -> Column | None:
        stored = (manifest or {}).get("marks", {}).get(ts)
        if stored is None:
            return None
        kind = batch.schema[ts].dataType
        return F.timestamp_micros(F.lit(stored)) if isinstance(kind, TimestampType) else F.lit(stored).cast(kind)

    def upsert(self, batch: DataFrame, keys: list[str], batch_id: int | None = None, ts: str | None = None,
               buckets: int = BUCKETS) -> Commit:
        """Replace the rows that share a key with a row of ``batch`` and add the others.

        With ``ts`` only rows above the table's mark (the largest ``ts`` committed) take part. Rows with a null
        key replace nothing. The schema must stay as it is. ``buckets`` counts for the first commit only.
        """
        m = self.manifest()
        if m is not None:
            if m["keys"] != keys:
                raise ValueError(f"{self.path} is kept by {m['keys']}, not {keys}")
            old = [(f["name"], f["type"]) for f in m["schema"]["fields"]]
            new = [(f["name"], f["type"]) for f in batch.schema.jsonValue()["fields"]]
            if sorted(old, key=str) != sorted(new, key=str):
                raise ValueError(f"schema of {self.path} changed: {old} to {new}")
            if batch_id is not None and batch_id <= m["batches"].get(self.writer, -1):
                return Commit(m["version"], False, [], None)
            buckets = m["buckets"]
        mark = self._mark(m, batch, ts) if ts else None
        late = None
        newer = batch
        if mark is not None:
            newer = batch.filter(F.col(ts) > mark)
            late = batch.filter(F.col(ts) <= mark).join(self._rows(m).select(*keys), keys, "left_anti")
        newer = newer.withColumn(BUCKET, self._bucket(keys, buckets)).persist()
        try:
            top = F.max(ts) if ts else F.lit(None)
            if ts and isinstance(batch.schema[ts].dataType, TimestampType):
                top = F.unix_micros(top)
            elif ts:
                top = top.cast("string")
            # one row per touched bucket
            seen = newer.groupBy(BUCKET).agg(top.alias("top"), F.max(ts).alias("raw") if ts else F.lit(0).alias("raw")).collect()
            touched = sorted(r[BUCKET] for r in seen)
            folder = f"data/{(m['version'] if m else -1) + 1}-{uuid.uuid4().hex}"
            if touched:
                rows = newer
                if m is not None:
                    old = self._rows(m, set(touched)).withColumn(BUCKET, self._bucket(keys, buckets))
                    rows = old.join(newer.select(*keys), keys, "left_anti").unionByName(newer)
                # a bucket becomes one file, or several where it is large
                rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        finally:
            newer.unpersist()
        tops = [r for r in seen if r["raw"] is not None]
        marks = dict((m or {}).get("marks", {}))
        if ts and tops:
            marks[ts] = max(tops, key=lambda r: r["raw"])["top"]
        batches = dict((m or {}).get("batches", {}))
        if batch_id is not None:
            batches[self.writer] = batch_id
        files = {**((m or {}).get("files", {})), **{str(b): f"{folder}/{BUCKET}={b}" for b in touched}}
        version = self._commit(m, {"schema": batch.schema.jsonValue(), "keys": keys, "buckets": buckets, "marks": marks,
                                   "batches": batches, "files": files})
        return Commit(version, True, touched, late)

    def replace(self, df: DataFrame, batch_id: int | None = None, partition_by: list[str] | None = None) -> Commit:
        """Commit ``df`` as the whole table."""
        m = self.manifest()
        if m is not None and batch_id is not None and batch_id <= m["batches"].get(self.writer, -1):
            return Commit(m["version"], False, [], None)
        folder = f"data/{(m['version'] if m else -1) + 1}-{uuid.uuid4().hex}"
        w = df.write.partitionBy(*partition_by) if partition_by else df.write
        w.parquet(f"{self.path}/{folder}")
        batches = dict((m or {}).get("batches", {}))
        if batch_id is not None:
            batches[self.writer] = batch_id
        version = self._commit(m, {"schema": df.schema.jsonValue(), "keys": [], "buckets": 1, "marks": {},
                                   "batches": batches, "files": {"0": folder}})
        return Commit(version, True, [0], None)

    def vacuum(self, keep: int = 2) -> int:
        """Remove data that none of the newest ``keep`` versions names; returns the number of folders."""
        current = self.version()
        if current is None:
            return 0
        names = {current}
        while len(names) < keep and (parent := self.manifest(min(names))["parent"]) >= 0:
            names.add(parent)
        used = {p.split("/")[1] for v in names for p in self.manifest(v)["files"].values()}
        gone = [n for n in self._names("data") if n not in used and int(n.split("-")[0]) <= current]
        for n in gone:
            self._fs.delete(self._at(f"data/{n}"), True)
        return len(gone)
