"""Registry of checkable queries: name -> (Spark builder, DuckDB oracle SQL or None).

A Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables (through the fixture views). The oracle is the same result written as one
SQL text over the raw tables; ``None`` marks jobs that SQL cannot express (they are
tested against a brute-force check in ``tests/``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rnd(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Round floating results so both engines agree on the printed value."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def load_all() -> dict:
    # importing the modules fills REGISTRY
    from lendnet.plans import (q_clean, q_graph, q_metrics, q_events, q_model,  # noqa: F401
                               q_cascade, q_embed)
    return REGISTRY
