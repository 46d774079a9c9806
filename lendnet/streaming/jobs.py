"""Structured Streaming jobs over the event log and application feed.

All jobs read a file source with a fixed schema (no inference), so they run the
same on a cluster's shared storage; sinks are idempotent per batch id, so a
restarted query that replays a micro-batch overwrites instead of appending twice.
The driver's timestamps arrive as ``timestamp_ntz``; watermarks need ``timestamp``,
so event-time columns are cast first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendnet.operators import drift as DR
from lendnet.operators.events import PANE, merge_panes, request_panes, rollup_by
from lendnet.session import cut_lineage
from lendnet.sources.sinks import dual_sink
from lendnet.sources.versioned import VersionedTable


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None,
                ts_cols: tuple[str, ...] = ()) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    df = r.parquet(path)
    for c in ts_cols:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def scoring_stream(apps: DataFrame, classes: DataFrame, stored_graph: DataFrame, baseline: DataFrame,
                   threshold: float) -> DataFrame:
    """Stateless scoring of an application stream (stream-static joins only)."""
    from lendnet.operators.model import score_applications
    events, _ = score_applications(apps, classes, stored_graph, threshold, baseline=baseline, materialize=False)
    return events.drop("_factors")


def reject_stream(apps: DataFrame, classes: DataFrame) -> DataFrame:
    """The applications that scoring refuses, with their reasons: (id, customer_id, reasons)."""
    from lendnet.operators.model import encode_requests, rejected
    return rejected(encode_requests(apps, classes))


def start_reject_sink(rejects: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append refused applications to their own table; each batch overwrites its own folder on replay."""
    w = (rejects.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={i}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_dual_sink(events: DataFrame, primary: str, secondary: str, checkpoint: str, available_now: bool = True):
    """Every micro-batch goes to two stores, keyed by batch id."""
    w = (events.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: dual_sink(b, i, primary, secondary)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def hourly_rollup_stream(events: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Hourly (band) count and score sum, maintained as events arrive (use update mode).

    The grouping key is the event-time window itself, which keeps the watermark (its start alone would
    not), so the state of hours past it is dropped.
    """
    late = events.withWatermark("scored_at", watermark)
    return rollup_by(late, F.window("scored_at", "1 hour")).withColumn("hour", F.col("hour.start"))


def band_counter_stream(events: DataFrame) -> DataFrame:
    """Running count per decision band (update mode)."""
    return events.groupBy("decision_band").agg(F.count(F.lit(1)).alias("n"))


def request_panes_stream(requests: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """One-minute panes with a logarithmic latency histogram (update mode; ``merge_panes`` makes the windows).

    An event enters one pane; the state is one small row per open minute and latency bucket."""
    late = requests.withWatermark("ts", watermark)
    return request_panes(late, pane=F.window("ts", PANE)).withColumn("pane", F.col("pane.start"))


def request_windows(spark: SparkSession, path: str) -> DataFrame:
    """Rate, p95 latency and 5xx ratio of the windows over the panes stored at ``path``."""
    return merge_panes(read_latest(spark, path))


def dedup_stream(events: DataFrame, key: str = "scoring_event_id", watermark: str = "2 hours") -> DataFrame:
    """Drop repeated event ids that arrive within the watermark."""
    return events.withWatermark("scored_at", watermark).dropDuplicatesWithinWatermark([key])


def upsert_latest(batch: DataFrame, batch_id: int, path: str, keys: list[str], ts: str | None = None,
                  keep: int = 2) -> None:
    """Upsert a micro-batch by ``keys`` into the versioned table at ``path``: touched buckets only, one commit per
    batch id, the newest ``keep`` versions kept. With ``ts`` only rows above the table's mark take part."""
    table = VersionedTable(batch.sparkSession, path)
    if table.upsert(batch, keys, batch_id, ts=ts).applied:
        table.vacuum(keep)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read()


def start_incremental_log(events: DataFrame, path: str, checkpoint: str, key: str = "scoring_event_id",
                          ts: str = "scored_at", available_now: bool = True):
    """The incremental event log, kept by a stream; a batch that is replayed after a crash is applied once."""
    w = (events.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: upsert_latest(b, i, path, [key], ts)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def drift_batches(batch: DataFrame, batch_id: int, reference: str, cols: list[str], out: str,
                  columns_out: str | None = None) -> None:
    """K-S of each micro-batch against the stored reference histogram at ``reference`` (never its rows); the
    summary goes to ``out``, the statistic of every column to ``columns_out`` where that is given."""
    stored = DR.read_reference(batch.sparkSession, reference)
    ks = cut_lineage(DR.ks_against_reference(stored, DR.value_histogram(batch, cols)))
    if columns_out is not None:
        (ks.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .parquet(f"{columns_out.rstrip('/')}/batch={batch_id}"))
    summary = DR.drift_summary(ks).drop("drift_by_column").withColumn("batch_id", F.lit(batch_id))
    summary.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")
