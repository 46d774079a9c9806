"""K-S of a batch against a stored, range-cut, mergeable reference histogram."""

import random

import pytest
from pyspark.sql import functions as F

from lendnet.operators import drift as DR
from lendnet.sources.versioned import VersionedTable


def exact(spark, ref, cur, cols):
    both = ref.select(*cols).withColumn("part", F.lit("reference")).unionByName(
        cur.select(*cols).withColumn("part", F.lit("current")))
    return {r["column"]: (r["ks_d"], r["n_ref"], r["n_cur"], r["p_value"]) for r in DR.ks_by_column(both, cols).collect()}


def frame(spark, rng, n, lo, hi):
    def x():
        return None if rng.random() < 0.1 else float(rng.randint(lo, hi))
    return spark.createDataFrame([(x(), x(), float(rng.gauss(lo, hi + 1))) for _ in range(n)], "a double, b double, c double")


@pytest.mark.parametrize("seed,values", [(1, 4), (3, 1 << 16)])
def test_equals_the_two_sample_statistic(spark, tmp_path, monkeypatch, seed, values):
    """Small ranges: batches inside, across, below, above and between the reference's ranges."""
    monkeypatch.setattr(DR, "RANGE_VALUES", values)
    rng = random.Random(seed)
    cols = ["a", "b", "c"]
    ref = frame(spark, rng, 300, 10, 60)
    path = str(tmp_path / "ref")
    DR.store_reference(DR.value_histogram(ref, cols), spark, path)
    stored = DR.read_reference(spark, path)
    assert (stored.select("column", "rng").distinct().count() > 3) == (values < 100)
    for lo, hi, n in ((0, 100, 80), (20, 25, 30), (-9, 5, 10), (12, 12, 1)):
        cur = frame(spark, rng, n, lo, hi)
        got = {r["column"]: (r["ks_d"], r["n_ref"], r["n_cur"], r["p_value"])
               for r in DR.ks_against_reference(stored, DR.value_histogram(cur, cols)).collect()}
        want = {c: v for c, v in exact(spark, ref, cur, cols).items() if v[2] > 0}
        assert got.keys() == want.keys()
        for c in want:
            assert got[c] == pytest.approx(want[c], abs=1e-12)


def test_merged_reference_and_replay(spark, tmp_path):
    rng = random.Random(7)
    cols = ["a", "c"]
    parts = [frame(spark, rng, 120, 0, 40) for _ in range(3)]
    path = str(tmp_path / "ref")
    DR.store_reference(DR.value_histogram(parts[0], cols), spark, path, 0)
    for i, p in enumerate(parts[1:], 1):
        for _ in range(2):                                   # a replayed batch is added once
            DR.merge_reference(DR.value_histogram(p, cols), spark, path, i)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    cur = frame(spark, rng, 90, 5, 50)
    got = {r["column"]: (r["ks_d"], r["n_ref"]) for r in DR.ks_against_reference(
        DR.read_reference(spark, path), DR.value_histogram(cur, cols)).collect()}
    want = {c: v[:2] for c, v in exact(spark, whole, cur, cols).items()}
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c]) for c in want)
    assert VersionedTable(spark, path).version() == 2
    # a batch without values, and one with a column the reference does not know
    empty = DR.value_histogram(cur.filter("false"), cols)
    assert DR.ks_against_reference(DR.read_reference(spark, path), empty).count() == 0
    other = DR.value_histogram(cur.withColumnRenamed("a", "z"), ["z", "c"])
    assert [r["column"] for r in DR.ks_against_reference(DR.read_reference(spark, path), other).collect()] == ["c"]
