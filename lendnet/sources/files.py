"""File sources and sinks with fixed schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendnet.schemas import CUSTOMER_CSV_SCHEMA, RAW_EDGE_SCHEMA
from lendnet.session import cut_lineage


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: headered borrower CSV with the fixed schema."""
    return spark.read.csv(path, header=True, schema=CUSTOMER_CSV_SCHEMA, mode="PERMISSIVE")


def read_raw_edges(spark: SparkSession, path: str) -> DataFrame:
    """A2: headerless ``source,target,weight,timestamp`` with ``#`` comments and padded fields."""
    return spark.read.csv(path, header=False, schema=RAW_EDGE_SCHEMA, comment="#",
                          ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def file_states(spark: SparkSession, files) -> tuple:
    """(file, size, modification time) of every file, in order of name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for f in sorted(files):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        state = path.getFileSystem(conf).getFileStatus(path)
        out.append((f, state.getLen(), state.getModificationTime()))
    return tuple(out)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def ordered_raw_edges(spark: SparkSession, path: str) -> DataFrame:
    """A2: the edge list with ``edge_ord`` = 0, 1, ... in the order of files (by name) and of lines inside a file.

    Lines are read once and stored. A split's place is its file and first byte, a line's place inside the split the
    order in which the split is read, so the numbers do not depend on how files are cut into splits or dealt over
    tasks. The table of splits (one row per split of the input) is what the offsets are computed on and broadcast."""
    raw = (read_raw_edges(spark, path).filter("source IS NOT NULL OR target IS NOT NULL")
           .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
           .withColumn("_m", F.monotonically_increasing_id()))
    raw = cut_lineage(raw)
    splits = raw.groupBy("_file", "_start").agg(F.min("_m").alias("_first"), F.max("_m").alias("_last"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    place = splits.select("_file", "_start", "_first", F.coalesce(
        F.sum(F.col("_last") - F.col("_first") + 1).over(before), F.lit(0)).alias("_off"))
    return (raw.join(F.broadcast(place), ["_file", "_start"])
            .withColumn("edge_ord", F.col("_off") + F.col("_m") - F.col("_first"))
            .drop("_file", "_start", "_m", "_first", "_off"))


def raw_edges_to_relationships(raw: DataFrame) -> DataFrame:
    """Network edges -> relationship rows: PROSPER_ ids, type 'loan', ordinal = place in the input (``edge_ord`` of
    ``ordered_raw_edges``; a frame without it is numbered by its partitions)."""
    order = F.col("edge_ord") if "edge_ord" in raw.columns else F.monotonically_increasing_id()
    return raw.select(
        order.alias("edge_ord"),
        F.concat(F.lit("PROSPER_"), F.col("source").cast("string")).alias("src_customer_id"),
        F.concat(F.lit("PROSPER_"), F.col("target").cast("string")).alias("dst_customer_id"),
        F.lit("loan").alias("edge_type"),
        F.col("timestamp").alias("ts_epoch"),
        F.col("weight"),
    )


def load_source(spark: SparkSession, data_dir: str) -> tuple[str, DataFrame]:
    """A3: use the network edge list when ``<dir>/prosper_user_loans_2016/edges.csv`` exists,
    else the flat borrower CSV. Returns (kind, frame); both kinds end in the same schemas."""
    net = f"{data_dir.rstrip('/')}/prosper_user_loans_2016/edges.csv"
    if path_exists(spark, net):
        return "network", raw_edges_to_relationships(ordered_raw_edges(spark, net))
    return "flat", read_customers_csv(spark, f"{data_dir.rstrip('/')}/credit_risk_dataset.csv")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A4: parquet cache (overwrite); optional directory partitioning for pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A5: headered CSV sink."""
    df.write.mode("overwrite").csv(path, header=True)


def replace_table(df: DataFrame, name: str, jdbc_url: str | None = None,
                  properties: dict | None = None) -> None:
    """Replace a table in one step (catalog table, or a JDBC table truncated and reloaded)."""
    if jdbc_url:
        (df.write.mode("overwrite").option("truncate", "true").option("batchsize", 5000)
         .jdbc(jdbc_url, name, properties=properties or {}))
    else:
        df.write.mode("overwrite").saveAsTable(name)


def materialize_model(df: DataFrame, name: str, how: str, path: str | None = None, key: str | None = None,
                      version: int | None = None) -> DataFrame:
    """Keep a model as a 'view' (computed at each read), a 'table' (replaced whole) or 'incremental'
    (rows of ``df`` upserted by ``key`` into versioned folders below ``path``); returns what readers see.
    """
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if how == "table":
        replace_table(df, name)
        return spark.table(name)
    if how != "incremental" or path is None or key is None or version is None:
        raise ValueError("how is 'view', 'table' or 'incremental' (with path, key and version)")
    from lendnet.streaming.jobs import read_latest, upsert_latest
    if path_exists(spark, path):
        old = read_latest(spark, path)
        if sorted(old.dtypes) != sorted(df.dtypes):
            raise ValueError(f"schema of {name} changed: {old.dtypes} to {df.dtypes}")
    upsert_latest(df, version, path, [key])
    return read_latest(spark, path)


def register_sources(views: dict[str, DataFrame]) -> None:
    """Name tables for SQL users (the ``source``/``ref`` layer)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
