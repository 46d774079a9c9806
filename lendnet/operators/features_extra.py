"""Quantile buckets with the edge rules of a quantile cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.order import exact_quantiles


def quartile_bucket(df: DataFrame, col: str, q: int = 4, name: str = "bucket") -> DataFrame:
    """Bucket by exact linear-interpolated quantile edges, right-closed; duplicate edges are
    dropped (labels shift down); the lowest edge belongs to bucket 0; nulls -> 0."""
    e = exact_quantiles(df, col, [i / q for i in range(q + 1)])  # ascending
    below = F.lit(0)
    for i, ei in enumerate(e):
        distinct = ei.isNotNull() if i == 0 else ei > e[i - 1]
        below = below + F.when(distinct & (ei < F.col(col)), 1).otherwise(0)
    return df.withColumn(name, F.when(F.col(col).isNull(), F.lit(0))
                         .otherwise(F.greatest(below - F.lit(1), F.lit(0))).cast("int"))
