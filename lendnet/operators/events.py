"""Scoring-event log: rollups, dashboards, incremental load, dedup, request windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendnet.schemas import GAUGE_STEPS


def band_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("decision_band").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "decision_band")


def hourly_rollup(events: DataFrame, ts: str = "scored_at") -> DataFrame:
    """(hour, decision_band, event_count, risk_sum) - the insert-maintained rollup, in batch."""
    return rollup_by(events, F.date_trunc("hour", F.col(ts)))


def rollup_by(events: DataFrame, hour) -> DataFrame:
    """The rollup over a given hour expression (a stream passes its window's start)."""
    return (events.groupBy(hour.alias("hour"), "decision_band")
            .agg(F.count(F.lit(1)).alias("event_count"), F.sum("risk_score").alias("risk_sum")))


def hourly_avg(rollup: DataFrame) -> DataFrame:
    """Re-aggregate partial rows: events and mean score per hour, in time order."""
    return (rollup.groupBy("hour").agg(F.sum("event_count").alias("events"),
                                       (F.sum("risk_sum") / F.sum("event_count")).alias("avg_score"))
            .orderBy("hour"))


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n"))


def recent_events(events: DataFrame, n: int = 20, ts: str = "scored_at") -> DataFrame:
    """Latest ``n`` events (top-k: TakeOrderedAndProject, no global sort)."""
    return events.orderBy(F.desc(ts), F.desc("scoring_event_id")).limit(n)


def incremental_load(target: DataFrame | None, source: DataFrame, key: str = "scoring_event_id",
                     ts: str = "scored_at") -> tuple[DataFrame, DataFrame]:
    """Rows of ``source`` newer than max(target.ts) upsert on ``key``.

    An empty or missing target has no high-water mark: everything loads. Returns
    (new table, late rows = source rows at or below the mark that are not loaded).
    Schemas must match exactly (a changed schema fails instead of evolving).
    """
    if target is None:
        return source, source.limit(0)
    if [(f.name, f.dataType) for f in target.schema] != [(f.name, f.dataType) for f in source.schema]:
        raise ValueError("schema change between target and source")
    mark = target.agg(F.max(ts)).scalar()
    newer = source.filter(mark.isNull() | (F.col(ts) > mark))
    late = source.filter(mark.isNotNull() & (F.col(ts) <= mark)).join(target.select(key), key, "left_anti")
    kept = target.join(newer.select(key), key, "left_anti")
    return kept.unionByName(newer), late


def dedup_events(events: DataFrame, key: str = "scoring_event_id", ts: str = "scored_at") -> DataFrame:
    """Keep one row per event id: the earliest (ties: smallest row content order)."""
    cols = [c for c in events.columns if c != key]
    w = events.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(F.col(ts), *[F.col(c) for c in cols
                                                                                  if c != ts])).alias("r"))
    return w.select(key, "r.*")


def sliding_windows(requests: DataFrame, ts: str = "ts", length: str = "5 minutes",
                    slide: str = "1 minute") -> DataFrame:
    return requests.withColumn("w", F.window(F.col(ts).cast("timestamp"), length, slide))


def request_rate(requests: DataFrame, ts: str = "ts") -> DataFrame:
    """Requests per second over 5-minute windows sliding by 1 minute."""
    w = sliding_windows(requests, ts)
    return w.groupBy(F.col("w.start").alias("window_start")).agg(
        (F.count(F.lit(1)) / F.lit(300.0)).alias("req_per_s"))


def latency_p95(requests: DataFrame, ts: str = "ts", exact: bool = True) -> DataFrame:
    w = sliding_windows(requests, ts)
    agg = (F.percentile(F.col("duration_s"), F.lit(0.95)) if exact
           else F.percentile_approx("duration_s", 0.95, 10000))
    return w.groupBy(F.col("w.start").alias("window_start")).agg(agg.alias("p95_s"))


def error_ratio(requests: DataFrame, ts: str = "ts") -> DataFrame:
    w = sliding_windows(requests, ts)
    return w.groupBy(F.col("w.start").alias("window_start")).agg(
        F.try_divide(F.sum((F.col("status") >= 500).cast("long")).cast("double"),
                     F.count(F.lit(1))).alias("error_ratio"))


# Monitoring panes: an event enters the one-minute pane of its time once; windows are merged from panes.

PANE = "1 minute"
PANES_A_WINDOW = 5
RELATIVE_ERROR = 0.01
_GAMMA = (1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR)


def latency_bucket(x) -> Column:
    """Number of the logarithmic bucket (gamma^(i-1), gamma^i] of a duration; durations of zero or less share the
    lowest bucket, null stays null."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x > 0, F.ceil(F.log(x) / F.lit(math.log(_GAMMA)))).when(x <= 0, F.lit(ZERO_BUCKET)).cast("int")


ZERO_BUCKET = -1_000_000


def bucket_value(i) -> Column:
    """The duration that stands for a bucket: within RELATIVE_ERROR of everything in it."""
    return F.when(i == ZERO_BUCKET, F.lit(0.0)).otherwise(
        F.lit(2.0 / (_GAMMA + 1.0)) * F.pow(F.lit(_GAMMA), i.cast("double")))


def request_panes(requests: DataFrame, ts: str = "ts", pane=None) -> DataFrame:
    """(pane, bucket, n, errors): one row per minute and latency bucket, however many requests there are."""
    pane = F.date_trunc("minute", F.col(ts)).cast("timestamp") if pane is None else pane
    return (requests.groupBy(pane.alias("pane"), latency_bucket("duration_s").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("status") >= 500).cast("long")).alias("errors")))


def histogram_quantile(buckets: str, p: float) -> Column:
    """Interpolated quantile (rank p * (n - 1)) of an array of (bucket, n): both order statistics around the rank
    come from their buckets, so the result is within RELATIVE_ERROR of the exact quantile."""
    return F.expr(f"""
        aggregate(
          array_sort(filter({buckets}, x -> x.bucket IS NOT NULL)),
          named_struct('seen', 0L, 'lo', CAST(NULL AS INT), 'hi', CAST(NULL AS INT),
                       'rank', {float(p)}D * (aggregate(filter({buckets}, x -> x.bucket IS NOT NULL), 0L,
                                                        (s, x) -> s + x.n) - 1)),
          (a, x) -> named_struct('seen', a.seen + x.n,
                                 'lo', IF(a.lo IS NULL AND a.seen + x.n > floor(a.rank), x.bucket, a.lo),
                                 'hi', IF(a.hi IS NULL AND a.seen + x.n > ceil(a.rank), x.bucket, a.hi),
                                 'rank', a.rank))""")


def merge_panes(panes: DataFrame, p: float = 0.95) -> DataFrame:
    """(window_start, req_per_s, p95_s, error_ratio) of 5-minute windows sliding by one minute, from panes.

    A pane row goes to the five windows it lies in; a window collects at most 5 x buckets small rows."""
    start = F.explode(F.array(*[F.col("pane") - F.expr(f"interval {k} minutes") for k in range(PANES_A_WINDOW)]))
    w = (panes.withColumn("window_start", start).groupBy("window_start", "bucket")
         .agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))
         .groupBy("window_start").agg(F.sum("n").alias("total"), F.sum("errors").alias("errors"),
                                      F.collect_list(F.struct("bucket", "n")).alias("buckets")))
    q = w.withColumn("q", histogram_quantile("buckets", p))
    lo, hi = bucket_value(F.col("q.lo")), bucket_value(F.col("q.hi"))
    return q.select("window_start", (F.col("total") / F.lit(60.0 * PANES_A_WINDOW)).alias("req_per_s"),
                    (lo + (hi - lo) * (F.col("q.rank") - F.floor("q.rank"))).alias("p95_s"),
                    F.try_divide(F.col("errors").cast("double"), F.col("total")).alias("error_ratio"))


def gauge_status(metrics: DataFrame) -> DataFrame:
    """Latest value per gauge with its severity: green / amber / red (AUC: low is bad)."""
    last = metrics.groupBy("metric").agg(F.max_by("value", "ts").alias("value"))
    sev = F.lit("green")
    for name, (amber, red) in GAUGE_STEPS.items():
        if name == "auc":
            s = F.when(F.col("value") < red, "red").when(F.col("value") < amber, "amber").otherwise("green")
        else:
            s = F.when(F.col("value") >= red, "red").when(F.col("value") >= amber, "amber").otherwise("green")
        sev = F.when(F.col("metric") == name, s).otherwise(sev)
    up = F.when(F.col("metric") == "up", F.when(F.col("value") >= 1, "UP").otherwise("DOWN"))
    return last.withColumn("status", F.coalesce(up, sev))


def latest_version(registry: DataFrame) -> DataFrame:
    """The row with the largest numeric version per model name."""
    return registry.groupBy("name").agg(F.max_by("version", F.col("version").cast("int")).alias("version"))


def stamp_events(df: DataFrame, key: str = "scoring_event_id", ts: str = "scored_at") -> DataFrame:
    """Give events an id (uuid) and an event time when missing, plus an ingest time."""
    out = df
    if key not in out.columns:
        out = out.withColumn(key, F.expr("uuid()"))
    if ts not in out.columns:
        out = out.withColumn(ts, F.current_timestamp())
    return out.withColumn("_ingested_at", F.current_timestamp())
