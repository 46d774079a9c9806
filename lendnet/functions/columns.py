"""Scalar Column functions (JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendnet.schemas import EDGE_STRESS, GRADES


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; nulls stay null (least/greatest would skip them)."""
    col = _c(c)
    out = col
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(col.isNull(), F.lit(None)).otherwise(out)


def encode_flag(c) -> Column:
    """'Y' -> 1, anything else (including null) -> 0."""
    return (F.coalesce(_c(c), F.lit("")) == "Y").cast("int")


def rate_band(c) -> Column:
    """Interest-rate band: > 15 high, > 10 medium, else (and null) low."""
    col = _c(c)
    return F.when(col > 15, "high").when(col > 10, "medium").otherwise("low")


RATE_BAND_SQL = ("CREATE OR REPLACE TEMPORARY FUNCTION rate_band(rate DOUBLE) RETURNS STRING "
                 "RETURN CASE WHEN rate > 15 THEN 'high' WHEN rate > 10 THEN 'medium' ELSE 'low' END")


def register_sql_functions(spark) -> None:
    """SQL form of ``rate_band`` for ``spark.sql`` users."""
    spark.sql(RATE_BAND_SQL)


def decision_band(p, threshold: float) -> Column:
    """< t/2 low, < t medium, else high."""
    col = _c(p)
    return (F.when(col < F.lit(threshold / 2.0), "low")
             .when(col < F.lit(threshold), "medium").otherwise("high"))


def vulnerability(income, loan) -> Column:
    """0.5 + min(loan/income, 1); 1.0 when either is missing or zero, or income <= 0."""
    i, l = _c(income), _c(loan)
    ok = i.isNotNull() & l.isNotNull() & (i != 0) & (l != 0) & ~F.isnan(i) & (i > 0)
    ratio = F.least(F.try_divide(l, i), F.lit(1.0))
    return F.when(ok, F.lit(0.5) + ratio).otherwise(F.lit(1.0))


def edge_stress(edge_type) -> Column:
    """Stress multiplier of a relationship type; unknown types transmit 1.0."""
    m = F.create_map(*[x for k, v in EDGE_STRESS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[_c(edge_type)], F.lit(1.0))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def grade_from_score(score) -> Column:
    """Grade letter of floor(score * 7), clipped into the grade list."""
    idx = F.least(F.greatest(F.floor(_c(score) * F.lit(len(GRADES))), F.lit(0)),
                  F.lit(len(GRADES) - 1)).cast("int")
    return F.element_at(F.array(*[F.lit(g) for g in GRADES]), idx + 1)


def hash_unit(*parts) -> Column:
    """Deterministic draw in [0, 1) from md5 of the '|'-joined parts.

    Same value in DuckDB: ('0x' || substr(md5(x), 1, 13))::BIGINT / 4503599627370496 (52 bits, so that
    floor(u * n) can reach every row of any table).
    """
    s = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def hash_key(*parts) -> Column:
    """Deterministic 52-bit bigint from md5 of the '|'-joined parts."""
    s = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("bigint")
