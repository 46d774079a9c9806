"""Hub-aware join helpers.

A relationship network can have a hub that touches a large share of all edges. A
join keyed on that hub puts all its rows in one task. ``salted_join`` spreads the
rows of heavy keys over ``buckets`` sub-keys: the left rows of a hub are split by a
hash, the right rows are replicated once per bucket. Heavy keys are found from a
degree table; their number is bounded by ``2E / threshold``, and the threshold grows
with E so the broadcast key list never exceeds ``max_hubs`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MIN_THRESHOLD = 1000
DEFAULT_MAX_HUBS = 100_000


def heavy_keys(deg: DataFrame, key: str, deg_col: str, total: "F.Column",
               min_threshold: int = DEFAULT_MIN_THRESHOLD,
               max_hubs: int = DEFAULT_MAX_HUBS, with_degree: bool = False) -> DataFrame:
    """Keys whose degree exceeds max(min_threshold, total / max_hubs).

    Since the degrees sum to ``total``, at most ``max_hubs`` keys can pass, which is
    the size bound that makes the result safe to broadcast.
    """
    thr = F.greatest(F.lit(float(min_threshold)), total / F.lit(float(max_hubs)))
    found = deg.filter(F.col(deg_col) > thr)
    degree = [F.col(deg_col).alias("_deg")] if with_degree else []
    return found.select(F.col(key).alias("_hk"), *degree)


def salt_count(degree: "F.Column", per_salt: int = DEFAULT_MIN_THRESHOLD) -> "F.Column":
    """Sub-keys of a hub: about ``per_salt`` of its rows each."""
    return F.greatest(F.ceil(degree / F.lit(float(max(per_salt, 1)))), F.lit(1)).cast("int")


def salted_join(left: DataFrame, right: DataFrame, key: str, hubs: DataFrame, how: str = "inner",
                per_salt: int = DEFAULT_MIN_THRESHOLD) -> DataFrame:
    """``left.join(right, key, how)`` with a hub's left rows dealt over sub-keys, about ``per_salt`` rows each, and
    its right rows copied to all of them. ``hubs``: ``heavy_keys(..., with_degree=True)``."""
    hk = F.broadcast(hubs.select("_hk", salt_count(F.col("_deg"), per_salt).alias("_salts")))
    lft = left.join(hk, left[key] == hk["_hk"], "left").drop("_hk")
    lft = lft.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("_salts")), F.lit(0))
                         .cast("int")).drop("_salts")
    rgt = right.join(hk, right[key] == hk["_hk"], "left").drop("_hk")
    rgt = rgt.withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)).cast("int")))).drop("_salts")
    return lft.join(rgt, [key, "_salt"], how).drop("_salt")
