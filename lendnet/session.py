"""Session construction and lineage control."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lendnet") -> SparkSession:
    """A session with AQE (coalescing + skew join) on and the UI off.

    On a cluster, ``master`` is left to spark-submit; locally pass ``local[N]``. The number of shuffle
    partitions is set only on request, or to 8 for a local master: elsewhere the cluster's own
    setting stands, since AQE can merge small partitions but not add any.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # checkpoints of finished loop steps go when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("LENDNET_DRIVER_MEM", "12g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we use it as is.
    Only when nothing is configured (local runs and tests) do we create one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="lendnet-ckpt-", dir=os.environ.get("LENDNET_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


ROWS_PER_PARTITION = 1_000_000


def partitions_for(rows: int, per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partition count from the data size (about ``per_partition`` rows each), not from a
    fixed setting: one task for tiny tables, many for large ones."""
    return max(1, -(-int(rows) // per_partition))


def persist_partitioned(df: DataFrame, key, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition a static loop input on ``key`` and keep it (memory, spilling to disk).

    Unlike a checkpoint, a cached relation keeps its output partitioning, so joins on
    ``key`` inside a loop do not re-shuffle it each step. Its lineage is short (no loop),
    so a lost block is recomputed from the source.
    """
    from pyspark import StorageLevel
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [key] if isinstance(key, str) else list(key)
    out = df.repartition(n, *keys).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def observed(watch, name: str):
    """A number of a finished ``Observation``; 0 where the plan turned out empty at run time, in which case the
    optimiser removes the observing node together with the plan."""
    from py4j.protocol import Py4JJavaError
    try:
        return watch.get[name] or 0
    except Py4JJavaError:          # the observation holds no row
        return 0


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and truncate its plan.

    Used by iterative jobs (frontier loops, PageRank) so a lost executor replays
    one step from shared storage rather than the whole loop.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
