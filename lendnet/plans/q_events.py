"""Event-log, dashboard and monitoring-window queries (survey §2.D D7-D10, §2.F F3/F4, §2.J)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendnet.operators import events as EV
from lendnet.operators.order import positional_split
from lendnet.plans.catalog import query, rnd
from lendnet.session import ensure_checkpoint_dir
from lendnet.sources import fixtures as FX
from lendnet.sources.fixtures import with_views
from lendnet.sources.versioned import VersionedTable

EV_COLS = ["scoring_event_id", "customer_id", "risk_score", "requested_amount", "scored_at", "decision_band"]


def events(spark, d):
    return FX.scoring_events(spark, d)


@query("band_distribution", with_views("""
select decision_band, count(*) as n from scoring_events group by 1""", "scoring_events"))
def band_distribution(spark, d):
    return EV.band_distribution(events(spark, d))


@query("hourly_rollup", with_views("""
select cast(date_trunc('hour', scored_at) as timestamp) as hour, decision_band, count(*) as event_count,
 round(sum(risk_score), 9) as risk_sum from scoring_events group by 1, 2""", "scoring_events"))
def hourly_rollup(spark, d):
    return rnd(EV.hourly_rollup(events(spark, d)), ["risk_sum"], 9)


@query("hourly_avg", with_views("""
with r as (select date_trunc('hour', scored_at) as hour, decision_band, count(*) as event_count,
             sum(risk_score) as risk_sum from scoring_events group by 1, 2)
select cast(hour as timestamp) as hour, sum(event_count)::bigint as events,
 round(sum(risk_sum) / sum(event_count), 9) as avg_score from r group by 1""", "scoring_events"))
def hourly_avg(spark, d):
    return rnd(EV.hourly_avg(EV.hourly_rollup(events(spark, d))), ["avg_score"], 9)


@query("event_count", with_views("select count(*) as n from scoring_events", "scoring_events"))
def event_count(spark, d):
    return EV.event_count(events(spark, d))


@query("recent_events", with_views("""
select * from scoring_events order by scored_at desc, scoring_event_id desc limit 20""", "scoring_events"))
def recent_events(spark, d):
    return EV.recent_events(events(spark, d), 20)


INCR = """
pos as (select *, row_number() over (order by requested_amount, scoring_event_id) - 1 as rn, count(*) over () as n
        from scoring_events),
target as (select scoring_event_id, customer_id, risk_score, requested_amount, scored_at, decision_band
           from pos where rn < floor(n * 0.8)),
mark as (select max(scored_at) as m from target),
newer as (select * from scoring_events where scored_at > (select m from mark)),
result as (select * from target where scoring_event_id not in (select scoring_event_id from newer)
           union all select * from newer),
late as (select * from scoring_events where scored_at <= (select m from mark)
         and scoring_event_id not in (select scoring_event_id from target))"""


def _incremental(spark, d):
    """The stored log after two commits (the target's rows, then the whole feed), and the feed's late rows."""
    ev = events(spark, d).select(*EV_COLS)
    target = positional_split(ev, ["requested_amount", "scoring_event_id"], 0.8).filter(
        F.col("part") == "reference").select(*EV_COLS)
    log = VersionedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/event-log-{uuid.uuid4().hex}")
    log.upsert(target, ["scoring_event_id"], 0, ts="scored_at")
    late = log.upsert(ev, ["scoring_event_id"], 1, ts="scored_at").late
    return log.read(), late


@query("incremental_log", with_views(f"with {INCR}\nselect * from result", "scoring_events"))
def incremental_log(spark, d):
    return _incremental(spark, d)[0]


@query("late_rows", with_views(f"with {INCR}\nselect * from late", "scoring_events"))
def late_rows(spark, d):
    return _incremental(spark, d)[1]


@query("dedup_events", with_views(f"""with {INCR}
select distinct * from (select * from target union all select * from scoring_events)""", "scoring_events"))
def dedup_events(spark, d):
    ev = events(spark, d).select(*EV_COLS)
    target = positional_split(ev, ["requested_amount", "scoring_event_id"], 0.8).filter(
        F.col("part") == "reference").select(*EV_COLS)
    return EV.dedup_events(target.unionByName(ev)).select(*EV_COLS)


WIN = """
win as (select r.*, time_bucket(interval '1 minute', ts) - k * interval '1 minute' as window_start
        from requests r, range(0, 5) t(k))"""


@query("request_rate", with_views(f"""with {WIN}
select window_start, round(count(*) / 300e0, 9) as req_per_s from win group by 1""", "requests"))
def request_rate(spark, d):
    return rnd(EV.request_rate(FX.requests(spark, d)), ["req_per_s"], 9)


@query("latency_p95", with_views(f"""with {WIN}
select window_start, round(quantile_cont(duration_s, 0.95), 9) as p95_s from win group by 1""", "requests"))
def latency_p95(spark, d):
    return rnd(EV.latency_p95(FX.requests(spark, d)), ["p95_s"], 9)


@query("error_ratio", with_views(f"""with {WIN}
select window_start, round(sum(case when status >= 500 then 1 else 0 end) * 1e0 / count(*), 9) as error_ratio
from win group by 1""", "requests"))
def error_ratio(spark, d):
    return rnd(EV.error_ratio(FX.requests(spark, d)), ["error_ratio"], 9)


PANE_SQL = """
panes as (select time_bucket(interval '1 minute', ts) as pane,
            case when duration_s > 0 then ceil(ln(duration_s) / ln(1.01e0 / 0.99e0)) when duration_s <= 0 then -1000000 end as b,
            count(*) as n, sum(case when status >= 500 then 1 else 0 end) as errors from requests group by 1, 2),
w as (select pane - k * interval '1 minute' as window_start, b, sum(n) as n, sum(errors) as errors
      from panes, range(0, 5) t(k) group by 1, 2),
tot as (select window_start, sum(n) as total, sum(errors) as errors,
               0.95e0 * (sum(case when b is not null then n end) - 1) as rank from w group by 1),
cum as (select window_start, b, sum(n) over (partition by window_start order by b) as upto from w where b is not null),
q as (select window_start, min(case when upto > floor(rank) then b end) as lo, min(case when upto > ceil(rank) then b end) as hi
      from cum join tot using (window_start) group by 1),
v as (select window_start,
        case when lo = -1000000 then 0e0 else 2e0 / (1.01e0 / 0.99e0 + 1) * pow(1.01e0 / 0.99e0, lo) end as lo,
        case when hi = -1000000 then 0e0 else 2e0 / (1.01e0 / 0.99e0 + 1) * pow(1.01e0 / 0.99e0, hi) end as hi from q)"""


@query("request_windows", with_views(f"""with {PANE_SQL}
select cast(window_start as timestamp) as window_start, round(total / 300e0, 9) as req_per_s,
 round(lo + (hi - lo) * (rank - floor(rank)), 9) as p95_s, round(errors * 1e0 / total, 9) as error_ratio
from tot left join v using (window_start)""", "requests"))
def request_windows(spark, d):
    panes = EV.request_panes(FX.requests(spark, d))
    return rnd(EV.merge_panes(panes), ["req_per_s", "p95_s", "error_ratio"], 9)


def hourly_metrics(spark, d):
    """Monitoring series derived from the request log: hourly error ratio and an 'up' gauge."""
    r = FX.requests(spark, d)
    h = r.groupBy(F.date_trunc("hour", F.col("ts")).alias("ts")).agg(
        (F.sum((F.col("status") >= 500).cast("long")) / F.count(F.lit(1))).alias("err"))
    return (h.select(F.lit("error_ratio").alias("metric"), F.col("err").alias("value"), "ts")
            .unionByName(h.select(F.lit("up").alias("metric"), F.lit(1.0).alias("value"), "ts")))


@query("gauge_status", with_views("""
with h as (select date_trunc('hour', ts) as ts, sum(case when status >= 500 then 1 else 0 end) * 1e0 / count(*) as err
           from requests group by 1),
m as (select 'error_ratio' as metric, err as value, ts from h union all select 'up', 1e0, ts from h),
last as (select metric, arg_max(value, ts) as value from m group by metric)
select metric, round(value, 9) as value,
 case when metric = 'up' then case when value >= 1 then 'UP' else 'DOWN' end
      when metric = 'error_ratio' then case when value >= 0.05 then 'red' when value >= 0.01 then 'amber' else 'green' end
      else 'green' end as status
from last""", "requests"))
def gauge_status(spark, d):
    return rnd(EV.gauge_status(hourly_metrics(spark, d)), ["value"], 9)


@query("latest_version", """
select o_orderpriority as name, arg_max(cast(o_orderkey as varchar), o_orderkey) as version
from orders group by 1""")
def latest_version(spark, d):
    o = FX.read_table(spark, d, "orders")
    reg = o.select(F.col("o_orderpriority").alias("name"), F.col("o_orderkey").cast("string").alias("version"))
    return EV.latest_version(reg)
