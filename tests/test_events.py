"""Incremental load edge cases: empty target (no high-water mark) and schema changes."""

import pytest
from pyspark.sql import functions as F

from lendnet.operators.events import incremental_load

SCHEMA = "scoring_event_id string, risk_score double, scored_at timestamp"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_target_loads_everything(spark):
    import datetime as dt
    src = _df(spark, [("a", 0.1, dt.datetime(2024, 1, 1)), ("b", 0.2, dt.datetime(2024, 1, 2))])
    out, late = incremental_load(_df(spark, []), src)
    assert out.count() == 2 and late.count() == 0


def test_upsert_newer_rows_and_report_late_ones(spark):
    import datetime as dt
    target = _df(spark, [("a", 0.1, dt.datetime(2024, 1, 2))])
    src = _df(spark, [("a", 0.9, dt.datetime(2024, 1, 3)), ("b", 0.2, dt.datetime(2024, 1, 1))])
    out, late = incremental_load(target, src)
    assert sorted((r.scoring_event_id, r.risk_score) for r in out.collect()) == [("a", 0.9)]
    assert [r.scoring_event_id for r in late.collect()] == ["b"]


def test_schema_change_fails(spark):
    target = _df(spark, [])
    src = target.withColumn("extra", F.lit(1))
    with pytest.raises(ValueError):
        incremental_load(target, src)
