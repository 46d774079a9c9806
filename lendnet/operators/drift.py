"""Distribution drift: two-sample Kolmogorov-Smirnov per numeric column.

Columns are unpivoted to (column, value, side), histogrammed by (column, value),
and the two empirical CDFs are prefix sums along value inside each column. The
statistic is the largest CDF gap; the p-value uses the asymptotic Kolmogorov
distribution with the effective sample size n1 n2 / (n1 + n2).

A scheduled check keeps the reference as a stored histogram: (column, value, n) with running sums, cut into ranges
of ``RANGE_VALUES`` distinct values. A batch is compared with it range by range: inside the ranges that hold values
of the batch the two curves are merged, elsewhere the batch's curve is flat and the gap is largest at a range's
end. The reference's rows are never read again, and histograms add up (``merge_reference``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.operators.order import prefix_sum
from lendnet.session import cut_lineage
from lendnet.sources.versioned import VersionedTable

RANGE_VALUES = 1 << 16


def grouped_prefix_sum(df: DataFrame, group: str, order: str, cols: list[str]) -> DataFrame:
    """Inclusive prefix sums of ``cols`` along ``order`` restarting at each ``group``.

    One global prefix sum over (group, order), minus each group's starting offset;
    the offset table has one row per group (here: per column or class, a small set).
    """
    p = prefix_sum(df, [group, order], cols)
    tot = df.groupBy(group).agg(*[F.sum(c).alias(f"{c}_g") for c in cols])
    w = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    start = tot.select(F.col(group).alias("_group"), *[F.coalesce(F.sum(f"{c}_g").over(w), F.lit(0)).alias(f"{c}_s") for c in cols],
                       *[F.col(f"{c}_g") for c in cols])
    j = p.join(start, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    return j.withColumns({f"{c}_cum": F.col(f"{c}_cum") - F.col(f"{c}_s") for c in cols}).drop(
        *[f"{c}_s" for c in cols])


def ks_pvalue(d, n1, n2, terms: int = 100):
    """Asymptotic two-sided p-value 2 sum_k (-1)^(k-1) exp(-2 k^2 lambda^2), clipped to [0, 1]."""
    en = n1 * n2 / (n1 + n2)
    lam = F.sqrt(en) * d
    s = None
    for k in range(1, terms + 1):
        t = F.lit((-1.0) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
        s = t if s is None else s + t
    p = F.lit(2.0) * s
    return F.when(lam < F.lit(0.05), F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def ks_by_column(df: DataFrame, cols: list[str], side_col: str = "part",
                 reference: str = "reference") -> DataFrame:
    """(column, ks_d, n_ref, n_cur, p_value) per column; nulls are ignored."""
    long = df.select(side_col, *cols).unpivot([side_col], cols, "column", "value").filter(F.col("value").isNotNull())
    h = (long.groupBy("column", F.col("value").cast("double").alias("v"))
         .agg(F.sum((F.col(side_col) == reference).cast("long")).alias("nr"),
              F.sum((F.col(side_col) != reference).cast("long")).alias("nc")))
    c = grouped_prefix_sum(h, "column", "v", ["nr", "nc"])
    gap = F.abs(F.col("nr_cum") / F.col("nr_g") - F.col("nc_cum") / F.col("nc_g"))
    res = c.groupBy("column").agg(F.max(gap).alias("ks_d"), F.first("nr_g").alias("n_ref"),
                                  F.first("nc_g").alias("n_cur"))
    return res.withColumn("p_value", ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"),
                                               F.col("n_cur").cast("double")))


def drift_summary(ks: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Drifted count, share, any-drift flag; per-column flags as a map."""
    flagged = ks.withColumn("drifted", F.col("p_value") < F.lit(alpha))
    return flagged.agg(
        F.sum(F.col("drifted").cast("int")).alias("n_drifted_columns"),
        (F.sum(F.col("drifted").cast("int")) / F.count(F.lit(1))).alias("drift_share"),
        (F.sum(F.col("drifted").cast("int")) > 0).alias("drift_detected"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "drifted")))).alias("drift_by_column"))


def value_histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, v, n): the distinct non-null values of every column as doubles; histograms of parts add up."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v")
    return long.filter("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))


def store_reference(hist: DataFrame, spark, path: str, batch_id: int | None = None) -> None:
    """Write a histogram as the reference at ``path``: n, running sums and range numbers; readers see the
    reference before or after, never a mixture."""
    h = grouped_prefix_sum(hist.withColumn("one", F.lit(1)), "column", "v", ["n", "one"])
    table = h.select("column", "v", "n", F.col("n_cum").alias("cum"), F.col("n_g").alias("total"),
                     F.floor((F.col("one_cum") - 1) / F.lit(RANGE_VALUES)).cast("long").alias("rng"))
    store = VersionedTable(spark, path)
    store.replace(table.repartition("column", "rng"), batch_id, partition_by=["column", "rng"])
    store.vacuum()


def read_reference(spark, path: str) -> DataFrame:
    """(column, v, n, cum, total, rng) of the stored reference."""
    return VersionedTable(spark, path).read()


def merge_reference(hist: DataFrame, spark, path: str, batch_id: int | None = None) -> None:
    """Add a batch's histogram to the stored reference (once per batch id)."""
    old = read_reference(spark, path).select("column", "v", "n")
    both = old.unionByName(hist).groupBy("column", "v").agg(F.sum("n").alias("n"))
    store_reference(both, spark, path, batch_id)


def ks_against_reference(reference: DataFrame, hist: DataFrame) -> DataFrame:
    """(column, ks_d, n_ref, n_cur, p_value) of a batch's histogram against a stored reference; columns that the
    reference does not hold are left out, columns without a value in the batch have none."""
    # one row per range of the reference: its bounds and running sum
    ends = cut_lineage(reference.groupBy("column", "rng").agg(
        F.min("v").alias("first"), F.max("cum").alias("cum_end"), F.max("total").alias("n_ref")))
    order = Window.partitionBy("column").orderBy("rng")
    bounds = ends.withColumn("next", F.lead("first").over(order))
    # the range of each of the batch's values (values below the first range belong to it)
    cur = (hist.join(F.broadcast(bounds), "column")
           .filter(((F.col("v") >= F.col("first")) | (F.col("rng") == 0))
                   & (F.col("next").isNull() | (F.col("v") < F.col("next"))))
           .select("column", "rng", "v", F.col("n").alias("c")))
    cur = cut_lineage(cur)
    before = Window.partitionBy("column").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    sums = (ends.join(cur.groupBy("column", "rng").agg(F.sum("c").alias("c")), ["column", "rng"], "left")
            .withColumn("c", F.coalesce("c", F.lit(0))))
    sums = sums.withColumn("c_before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    sums = sums.withColumn("r_before", F.coalesce(F.max("cum_end").over(before), F.lit(0)))
    sums = cut_lineage(sums.withColumn("n_cur", F.sum("c").over(Window.partitionBy("column"))))
    gap = F.abs(F.col("r") / F.col("n_ref") - F.col("k") / F.col("n_cur"))
    at_ends = sums.select("column", "n_ref", "n_cur", F.col("cum_end").alias("r"), (F.col("c_before") + F.col("c")).alias("k"))
    # inside touched ranges: both curves along the values (at most RANGE_VALUES of the reference's a window, and
    # the batch's own distinct values between its bounds)
    touched = F.broadcast(sums.filter("c > 0").drop("c"))
    merged = (reference.select("column", "rng", "v", "cum", F.lit(0).cast("long").alias("c"))
              .unionByName(cur.select("column", "rng", "v", F.lit(None).cast("long").alias("cum"), "c"))
              .groupBy("column", "rng", "v").agg(F.max("cum").alias("cum"), F.sum("c").alias("c"))
              .join(touched, ["column", "rng"]))
    along = Window.partitionBy("column", "rng").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = merged.select("column", "n_ref", "n_cur",
                           F.coalesce(F.max("cum").over(along), F.col("r_before")).alias("r"),
                           (F.sum("c").over(along) + F.col("c_before")).alias("k"))
    res = (at_ends.unionByName(inside).filter("n_cur > 0").withColumn("gap", gap)
           .groupBy("column").agg(F.max("gap").alias("ks_d"), F.first("n_ref").alias("n_ref"),
                                  F.first("n_cur").alias("n_cur")))
    return res.withColumn("p_value", ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"),
                                               F.col("n_cur").cast("double")))
