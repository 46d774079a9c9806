"""Stream = batch: the streaming jobs over a file source reproduce the batch results."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from lendnet.operators import drift as DR
from lendnet.operators.events import band_distribution, hourly_rollup
from lendnet.sources import fixtures as FX
from lendnet.streaming import jobs as SJ


def _write_chunks(df, path, n=4, ts=None):
    """Append ``n`` files; with ``ts`` they are in event-time order (one time range each)."""
    import time
    if ts is None:
        df.repartition(n).write.mode("overwrite").parquet(path)
        return
    lo, hi = df.agg(F.min(ts).cast("long"), F.max(ts).cast("long")).first()
    step = (hi - lo) // n + 1
    for k in range(n):
        part = df.filter((F.col(ts).cast("long") >= lo + k * step) & (F.col(ts).cast("long") < lo + (k + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_hourly_rollup_and_band_counter_stream_equal_batch(spark):
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    ev = FX.scoring_events(spark, SF001).withColumn("scored_at", F.col("scored_at").cast("timestamp"))
    src = os.path.join(tmp, "events")
    _write_chunks(ev, src, ts="scored_at")
    stream = SJ.read_stream(spark, src, ev.schema, files_per_trigger=1)
    out = os.path.join(tmp, "rollup")
    q = (SJ.hourly_rollup_stream(stream).writeStream.outputMode("update")
         .option("checkpointLocation", os.path.join(tmp, "ck1"))
         .foreachBatch(lambda b, i: SJ.upsert_latest(b, i, out, ["hour", "decision_band"]))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = SJ.read_latest(spark, out)
    exp = hourly_rollup(ev)
    cols = ["hour", "decision_band", "event_count"]
    assert _rows(got, cols) == _rows(exp, cols)

    out2 = os.path.join(tmp, "bands")
    q2 = (SJ.band_counter_stream(SJ.read_stream(spark, src, ev.schema, files_per_trigger=1))
          .writeStream.outputMode("update").option("checkpointLocation", os.path.join(tmp, "ck2"))
          .foreachBatch(lambda b, i: SJ.upsert_latest(b, i, out2, ["decision_band"]))
          .trigger(availableNow=True).start())
    q2.awaitTermination()
    assert _rows(SJ.read_latest(spark, out2), ["decision_band", "n"]) == _rows(band_distribution(ev),
                                                                               ["decision_band", "n"])


def test_dedup_within_watermark(spark):
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    ev = FX.scoring_events(spark, SF001).withColumn("scored_at", F.col("scored_at").cast("timestamp"))
    src = os.path.join(tmp, "events")
    _write_chunks(ev.unionByName(ev), src)
    out = os.path.join(tmp, "dedup")
    q = (SJ.dedup_stream(SJ.read_stream(spark, src, ev.schema)).writeStream
         .option("checkpointLocation", os.path.join(tmp, "ck")).format("parquet").option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(out).count() == ev.count()


def test_request_panes_stream_makes_the_windows(spark):
    """Panes kept by a stream, merged into windows: rate and error ratio exact, p95 within the stated error."""
    from lendnet.operators.events import RELATIVE_ERROR, error_ratio, latency_p95, request_rate
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    req = FX.requests(spark, SF001).withColumn("ts", F.col("ts").cast("timestamp"))
    src = os.path.join(tmp, "req")
    _write_chunks(req, src, ts="ts")
    out = os.path.join(tmp, "panes")
    panes = SJ.request_panes_stream(SJ.read_stream(spark, src, req.schema, files_per_trigger=2))
    q = (panes.writeStream.outputMode("update").option("checkpointLocation", os.path.join(tmp, "ck"))
         .foreachBatch(lambda b, i: SJ.upsert_latest(b, i, out, ["pane", "bucket"]))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = SJ.request_windows(spark, out)
    for col, exact in (("req_per_s", request_rate(req)), ("error_ratio", error_ratio(req))):
        assert _rows(got, ["window_start", col]) == _rows(exact, ["window_start", col])
    p95 = {r["window_start"]: r["p95_s"] for r in got.collect()}
    for r in latency_p95(req).collect():
        assert abs(p95[r["window_start"]] - r["p95_s"]) <= RELATIVE_ERROR * r["p95_s"] * (1 + 1e-9)
    # one state row per open pane and bucket, not one per event and window
    states = [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    updated = sum(s.numRowsUpdated for p in q.recentProgress for s in p.stateOperators)
    assert max(states) <= req.count() and updated <= req.count()
    assert sum(s.numRowsRemoved for p in q.recentProgress for s in p.stateOperators) > 0


def test_pane_histogram_on_odd_durations(spark):
    import datetime as dt
    from lendnet.operators.events import merge_panes, request_panes
    t = dt.datetime(2024, 1, 1, 0, 7, 30)
    values = [0.0, -1.0, None, 1e-9, 3.0, 3.0, 1e9]
    req = spark.createDataFrame([(t, v, 200) for v in values], "ts timestamp, duration_s double, status int")
    panes = request_panes(req)
    assert panes.agg(F.sum("n")).first()[0] == len(values)
    for p, exact in ((0.0, 0.0), (0.5, 1.5), (1.0, 1e9), (0.6, 3.0)):
        rows = merge_panes(panes, p).collect()
        assert len(rows) == 5 and abs(rows[0]["p95_s"] - exact) <= 0.01 * exact + 1e-6
    only_null = request_panes(req.filter("duration_s is null"))
    assert {r["p95_s"] for r in merge_panes(only_null).collect()} == {None}
    assert merge_panes(request_panes(req.filter("false"))).count() == 0
    big = spark.range(200_000).select(F.lit(t).alias("ts"), (F.col("id") % 997 / 100.0).alias("duration_s"), F.lit(500).alias("status"))
    assert request_panes(big).count() < 450              # a hot minute is a few hundred rows


def test_scoring_stream_equals_batch_and_dual_sink(spark):
    from lendnet.operators import clean as CL, model as MD
    from lendnet.operators.graph.features import graph_features
    from lendnet.plans.q_clean import clean_view
    from lendnet.schemas import CAT_COLS
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    gf = graph_features(FX.customers(spark, SF001), FX.edges(spark, SF001))
    j = clean_view(spark, SF001).join(gf, "customer_id", "left")
    classes = CL.label_classes(j, CAT_COLS)
    baseline = MD.derived_features(MD.label_encode(j, classes, CAT_COLS))
    apps = FX.applications(spark, SF001)
    src = os.path.join(tmp, "apps")
    _write_chunks(apps, src, n=3)
    stream = SJ.read_stream(spark, src, apps.schema, files_per_trigger=1)
    events = SJ.scoring_stream(stream, classes, gf, baseline, 0.441)
    q = SJ.start_dual_sink(events, os.path.join(tmp, "pg"), os.path.join(tmp, "ch"), os.path.join(tmp, "ck"))
    q.awaitTermination()
    batch, _ = MD.score_applications(apps, classes, gf, 0.441, baseline=baseline)
    cols = ["scoring_event_id", "risk_score", "decision_band", "top_factors"]
    exp = _rows(batch, cols)
    assert _rows(spark.read.parquet(os.path.join(tmp, "pg")), cols) == exp
    assert _rows(spark.read.parquet(os.path.join(tmp, "ch")), cols) == exp


def test_drift_on_micro_batches(spark):
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_discount")
    src = os.path.join(tmp, "li")
    _write_chunks(li, src, n=2)
    out, ref, cols = os.path.join(tmp, "drift"), os.path.join(tmp, "reference"), ["l_quantity", "l_discount"]
    DR.store_reference(DR.value_histogram(li, cols), spark, ref)
    q = (SJ.read_stream(spark, src, li.schema, files_per_trigger=1).writeStream
         .option("checkpointLocation", os.path.join(tmp, "ck"))
         .foreachBatch(lambda b, i: SJ.drift_batches(b, i, ref, cols, out, os.path.join(tmp, "columns")))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(out).collect()
    assert len(res) == 2 and all(0 <= r.drift_share <= 1 for r in res)
    logged = spark.read.parquet(os.path.join(tmp, "columns")).collect()
    assert sorted((r["batch"], r["column"]) for r in logged) == [(b, c) for b in (0, 1) for c in sorted(cols)]


def test_rollup_state_is_dropped_behind_the_watermark(spark):
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    ev = FX.scoring_events(spark, SF001).withColumn("scored_at", F.col("scored_at").cast("timestamp"))
    src = os.path.join(tmp, "events")
    _write_chunks(ev, src, n=3, ts="scored_at")
    q = (SJ.hourly_rollup_stream(SJ.read_stream(spark, src, ev.schema, files_per_trigger=1))
         .writeStream.outputMode("update").option("checkpointLocation", os.path.join(tmp, "ck"))
         .foreachBatch(lambda b, i: b.count()).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sum(s.numRowsRemoved for p in q.recentProgress for s in p.stateOperators) > 0


def test_replayed_batch_and_failed_read(spark, tmp_path):
    import pytest
    path = str(tmp_path / "t")
    a, b = (spark.createDataFrame(x, "k long, n long") for x in ([(1, 1)], [(1, 2), (2, 5)]))
    SJ.upsert_latest(a, 0, path, ["k"])
    for _ in range(2):
        SJ.upsert_latest(b, 1, path, ["k"])
        assert _rows(SJ.read_latest(spark, path), ["k", "n"]) == [(1, 2), (2, 5)]
    broken = tmp_path / "u" / "batch_version=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        SJ.upsert_latest(a, 1, str(tmp_path / "u"), ["k"])


def test_rejected_applications_reach_their_own_sink(spark):
    from lendnet.operators import clean as CL
    from lendnet.operators.graph.features import graph_features
    from lendnet.plans.q_clean import clean_view
    from lendnet.schemas import CAT_COLS
    tmp = tempfile.mkdtemp(prefix="lendnet-stream-")
    gf = graph_features(FX.customers(spark, SF001), FX.edges(spark, SF001))
    classes = CL.label_classes(clean_view(spark, SF001), CAT_COLS)
    apps = FX.applications(spark, SF001)
    src = os.path.join(tmp, "apps")
    _write_chunks(apps, src, n=2)
    stream = SJ.read_stream(spark, src, apps.schema, files_per_trigger=1)
    q = SJ.start_reject_sink(SJ.reject_stream(stream, classes), os.path.join(tmp, "rej"), os.path.join(tmp, "ck"))
    q.awaitTermination()
    from lendnet.operators.model import score_applications
    want = score_applications(apps, classes, gf, 0.441)[1]
    got = spark.read.parquet(os.path.join(tmp, "rej"))
    assert got.count() == want.count() > 0
