"""Versioned tables: touched buckets, crash between version and pointer, replays, readers, marks, vacuum."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lendnet.sources.versioned import VersionedTable
from lendnet.streaming import jobs as SJ

SCHEMA = "id long, v string, ts timestamp"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def frame(spark, items):
    return spark.createDataFrame([(i, v, day(t)) for i, v, t in items], SCHEMA)


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    first = t.upsert(frame(spark, [(i, "a", 0) for i in range(200)]), ["id"], 0, buckets=8)
    before = t.manifest()["files"]
    assert len(before) == 8 and first.version == 0
    second = t.upsert(frame(spark, [(3, "b", 1)]), ["id"], 1)
    after = t.manifest()["files"]
    assert len(second.touched) == 1
    assert {b for b in after if after[b] != before[b]} == {str(second.touched[0])}
    assert rows(t.read()) == sorted([(i, "a") for i in range(200) if i != 3] + [(3, "b")])
    assert rows(t.read(0)) == [(i, "a") for i in range(200)]          # the version before stays readable


def test_mark_late_rows_and_schema(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.version() is None
    with pytest.raises(ValueError):
        t.read()
    t.upsert(frame(spark, [(1, "a", 5)]), ["id"], 0, ts="ts")
    c = t.upsert(frame(spark, [(1, "old", 4), (2, "late", 5), (3, "new", 6), (None, "null", 7)]), ["id"], 1, ts="ts")
    assert rows(t.read().filter("id is not null")) == [(1, "a"), (3, "new")] and t.read().count() == 3
    assert rows(c.late) == [(2, "late")]
    t.upsert(frame(spark, [(1, "x", 7), (4, "y", 8)]), ["id"], 2, ts="ts")           # the mark is 7 now
    assert rows(t.read().filter("id is not null")) == [(1, "a"), (3, "new"), (4, "y")]
    with pytest.raises(ValueError):
        t.upsert(frame(spark, []).withColumn("more", F.lit(1)), ["id"], 3)
    with pytest.raises(ValueError):
        t.upsert(frame(spark, []), ["v"], 3)
    v = t.version()
    assert t.upsert(frame(spark, []), ["id"], 3, ts="ts").touched == [] and t.version() == v + 1


def test_kinds_of_marks(spark, tmp_path):
    for name, values in (("ntz", "timestamp_ntz'2024-01-01 00:00:00.123456'"), ("date", "date'2024-01-01'"),
                         ("n", "10"), ("d", "1.25d")):
        t = VersionedTable(spark, str(tmp_path / name))
        df = spark.sql(f"select 1 as id, {values} as ts")
        t.upsert(df, ["id"], ts="ts")
        again = t.upsert(df.withColumn("id", F.lit(2)), ["id"], ts="ts")
        assert again.touched == [] and again.late.count() == 1 and t.read().count() == 1


class Stop(Exception):
    pass


def test_crash_between_version_and_pointer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path)
    t.upsert(frame(spark, [(i, "a", 0) for i in range(50)]), ["id"], 0, ts="ts")
    open_reader = t.read()
    feed = frame(spark, [(i, "b", 1) for i in range(40, 60)])
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_swap", lambda self, v: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            t.upsert(feed, ["id"], 1, ts="ts")
    old = [(i, "a") for i in range(50)]
    assert os.path.exists(f"{path}/manifest/1.json")                  # written, but no reader sees it
    assert t.version() == 0 and rows(t.read()) == old
    for _ in range(2):                                                # replay, then a replay of what is committed
        t.upsert(feed, ["id"], 1, ts="ts")
        assert t.version() == 2
        assert rows(t.read()) == old[:40] + [(i, "b") for i in range(40, 60)]
    assert rows(open_reader) == old                                   # a reader that started before sees its version
    assert t.vacuum(keep=1) >= 1 and rows(t.read())[-1] == (59, "b")
    assert t.vacuum(keep=1) == 0


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.upsert(frame(spark, [(1, "a", 0)]), ["id"])
    parent = t.manifest()
    t.upsert(frame(spark, [(2, "b", 0)]), ["id"])
    with pytest.raises(RuntimeError):
        t._commit(parent, {})


def test_stream_that_dies_before_the_pointer(spark, tmp_path, monkeypatch):
    src, path, ck = (str(tmp_path / x) for x in ("src", "log", "ck"))
    batches = [[(i, "a", 0) for i in range(30)], [(i, "b", 1) for i in range(20, 45)], [(i, "c", 2) for i in range(40, 50)]]
    for n, b in enumerate(batches):
        frame(spark, b).coalesce(1).write.mode("append").parquet(src)
        for f in os.listdir(src):                                     # one file per batch, in order of time
            if f.endswith(".parquet") and not os.path.exists(f"{src}/.{f}.seen"):
                os.utime(f"{src}/{f}", (1_700_000_000 + n * 100,) * 2)
                open(f"{src}/.{f}.seen", "w").close()
    real, calls = VersionedTable._swap, []

    def swap(self, version):
        calls.append(version)
        if len(calls) == 2:
            raise Stop()
        real(self, version)
    monkeypatch.setattr(VersionedTable, "_swap", swap)

    def run():
        feed = SJ.read_stream(spark, src, frame(spark, []).schema, files_per_trigger=1)
        q = SJ.start_incremental_log(feed, path, ck, key="id", ts="ts")
        q.awaitTermination()
    with pytest.raises(Exception):
        run()
    assert rows(SJ.read_latest(spark, path)) == [(i, "a") for i in range(30)]
    run()                                                             # batch 1 is replayed, batch 2 follows
    want = {i: v for b in batches for i, v, _ in b}
    assert rows(SJ.read_latest(spark, path)) == sorted(want.items())
    assert VersionedTable(spark, path).manifest()["batches"] == {"default": 2}
