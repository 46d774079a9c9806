"""Data-quality tests as aggregations: unique, not_null, accepted_values, report.

A rule list runs as one aggregate per table (a single scan), then the per-rule
failure counts are unpivoted into one row per rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null keys that occur more than once: (value, n)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def dq_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is outside ``values`` (nulls pass, as in the SQL test)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


@dataclass(frozen=True)
class Rule:
    """``test``: 'unique', 'not_null', 'accepted_values' (``values``), or a property of the table:

    * 'bounds': every non-null value lies in [values[0], values[1]] (None: open end);
    * 'starts_with': every non-null value begins with values[0];
    * 'differs': the column differs from column values[0] in every row (nulls pass);
    * 'equals': a Boolean SQL expression values[0] holds in every row (null: holds);
    * 'sums_to': |sum of the column - values[0]| <= values[1]; one failure or none;
    * 'ratio': rows of the table over rows of table values[0] lies in [values[1], values[2]]; one failure or none;
    * 'subset': every non-null value occurs in column values[1] of table values[0] (rows that do not fail).
    """
    table: str
    column: str
    test: str
    values: tuple = ()
    name: str = ""             # tells rules of one column and test apart


ROW_TESTS = ("not_null", "accepted_values", "bounds", "starts_with", "differs", "equals")


def _row_failures(r: Rule):
    """Number of failing rows as an aggregate."""
    c = F.col(r.column)
    if r.test == "not_null":
        bad = c.isNull()
    elif r.test == "accepted_values":
        bad = c.isNotNull() & ~c.isin(*r.values)
    elif r.test == "bounds":
        lo, hi = r.values
        bad = F.lit(False) if lo is None else c < F.lit(lo)
        bad = bad if hi is None else bad | (c > F.lit(hi))
        bad = bad | F.isnan(c.cast("double"))
    elif r.test == "starts_with":
        bad = ~c.cast("string").startswith(r.values[0])
    elif r.test == "differs":
        bad = c == F.col(r.values[0])
    else:
        bad = ~F.expr(r.values[0])
    return F.coalesce(F.sum(F.coalesce(bad, F.lit(False)).cast("long")), F.lit(0))


def dq_properties(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table_name, column_name, test, name, failures): every table is aggregated once for all its row, sum and
    ratio rules (each rule one expression of that aggregate); a subset rule is one anti-join, whose reference is
    reduced to its distinct keys, and a unique rule one grouped count. Row counts for ratios come from the same
    aggregates. An empty table fails nothing but its ratio and sum rules."""
    counted = {r.values[0] for r in rules if r.test == "ratio"}
    sizes, parts = {}, []
    for r in rules:
        if r.test not in (*ROW_TESTS, "unique", "subset", "sums_to", "ratio"):
            raise ValueError(r.test)
    grouped = [r for r in rules if r.test not in ("unique", "subset")]
    for t in sorted({r.table for r in grouped} | counted):
        own = [(i, r) for i, r in enumerate(rules) if r.table == t and r in grouped]
        exprs = [F.count(F.lit(1)).alias("n")]
        exprs += [_row_failures(r).cast("double").alias(f"r{i}") for i, r in own if r.test in ROW_TESTS]
        exprs += [F.coalesce(F.sum(r.column), F.lit(0.0)).cast("double").alias(f"r{i}") for i, r in own if r.test == "sums_to"]
        sizes[t] = (tables[t].agg(*exprs), own)
    for row, own in sizes.values():
        found = []
        for i, r in own:
            if r.test in ROW_TESTS:
                e = F.col(f"r{i}")
            elif r.test == "sums_to":
                e = F.abs(F.col(f"r{i}") - F.lit(float(r.values[0]))) > F.lit(float(r.values[1]))
            else:
                other, lo, hi = r.values
                share = F.try_divide(F.col("n").cast("double"), tables[other].agg(F.count(F.lit(1))).scalar())
                e = ~F.coalesce(share.between(lo, hi), F.lit(False))
            found.append(F.struct(F.lit(i).alias("i"), e.cast("long").alias("failures")))
        if found:
            # all rules of a table from its one row
            parts.append(row.select(F.inline(F.array(*found))))
    for i, r in enumerate(rules):
        if r.test == "subset":
            table, column = r.values
            known = tables[table].select(F.col(column).alias("_key")).distinct()
            left = tables[r.table].filter(F.col(r.column).isNotNull()).join(
                known, F.col(r.column) == F.col("_key"), "left_anti")
            parts.append(left.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("failures")))
        elif r.test == "unique":
            parts.append(dq_unique(tables[r.table], r.column).agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)

    def named(field):
        return F.element_at(F.array(*[F.lit(getattr(r, field)) for r in rules]), F.col("i") + 1)
    return out.select(named("table").alias("table_name"), named("column").alias("column_name"),
                      named("test").alias("test"), named("name").alias("name"), F.col("failures").cast("long"))


def assert_properties(report: DataFrame) -> None:
    """Raise with the failing rules of a report (at most one row a rule reaches the driver)."""
    bad = report.filter("failures > 0").collect()
    if bad:
        raise AssertionError("; ".join(
            f"{r['table_name']}.{r['column_name']} {r['test']} {r['name']}: {r['failures']}".replace("  ", " ") for r in bad))


def dq_report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table_name, column_name, test, failures) for every rule, one aggregate per table."""
    return dq_properties(tables, rules).drop("name")
