"""Cleaning, staging and validation of borrower tables and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.functions.columns import clip, encode_flag
from lendnet.operators.drift import grouped_prefix_sum
from lendnet.session import cut_lineage
from lendnet.schemas import AGE_MAX, AGE_MIN, VALID_EDGE_TYPES


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace nulls by the exact median of the column (nulls ignored).

    One histogram and one prefix sum over (column, value) serve all columns.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v")
    h = long.filter("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    c = grouped_prefix_sum(h, "column", "v", ["n"])              # n_cum = count of values <= v, n_g = all
    pos = (F.col("n_g") - 1) / F.lit(2.0)
    mid = c.groupBy("column").agg(F.min(F.when(F.col("n_cum") > F.floor(pos), F.col("v"))).alias("lo"),
                                  F.min(F.when(F.col("n_cum") > F.ceil(pos), F.col("v"))).alias("hi"))
    median = cut_lineage(mid.select("column", ((F.col("lo") + F.col("hi")) / F.lit(2.0)).alias("m")))   # a row per column
    return df.withColumns({k: F.coalesce(F.col(k), median.filter(F.col("column") == k).select("m").scalar())
                           for k in cols})


def clip_outliers(df: DataFrame, caps: dict[str, tuple]) -> DataFrame:
    """``caps``: column -> (lo, hi); either bound may be None."""
    return df.withColumns({c: clip(c, lo, hi).cast(df.schema[c].dataType) for c, (lo, hi) in caps.items()})


def loan_pct_income(loan, income):
    """Loan / income, clipped at [0, 0.8], 2 decimals."""
    return F.round(clip(F.try_divide(loan, income), 0.0, 0.8), 2)


def clean_customers(df: DataFrame) -> DataFrame:
    """Median fill -> caps -> Y/N encoding -> label flag -> constant crisis column.

    Medians are taken before capping, as in the reference; ``loan_percent_income``
    is derived when the input has none.
    """
    out = fill_median(df, ["person_emp_length", "loan_int_rate"])
    out = clip_outliers(out, {"person_age": (None, 100), "person_income": (None, 500000.0)})
    out = out.withColumn("cb_person_default_on_file", encode_flag("cb_person_default_on_file"))
    if "loan_percent_income" not in out.columns:
        out = out.withColumn("loan_percent_income", loan_pct_income(F.col("loan_amnt"), F.col("person_income")))
    return out.withColumns({
        "is_recent_default": F.col("loan_status") == 1,
        "crisis_exposure": F.lit(0.0),
    })


def stg_customers(df: DataFrame) -> DataFrame:
    """Typed staging projection + filter age > 18, income > 0, amount > 0.

    Integer casts round like the SQL original (``::integer`` rounds half to even).
    """
    def to_int(c):
        return F.bround(F.col(c).cast("double")).cast("int")

    out = df.select(
        "customer_id",
        to_int("person_age").alias("person_age"),
        F.col("person_income").cast("double").alias("person_income"),
        "person_home_ownership",
        F.col("person_emp_length").cast("double").alias("person_emp_length"),
        "loan_intent", "loan_grade",
        F.col("loan_amnt").cast("double").alias("loan_amnt"),
        F.col("loan_int_rate").cast("double").alias("loan_int_rate"),
        to_int("loan_status").alias("loan_status"),
        F.col("loan_percent_income").cast("double").alias("loan_percent_income"),
        to_int("cb_person_default_on_file").alias("cb_person_default_on_file"),
        to_int("cb_person_cred_hist_length").alias("cb_person_cred_hist_length"),
        F.col("is_recent_default").cast("boolean").alias("is_recent_default"),
    )
    return out.filter((F.col("person_age") > 18) & (F.col("person_income") > 0) & (F.col("loan_amnt") > 0))


def stg_graph_features(df: DataFrame) -> DataFrame:
    ints = ["degree", "in_degree", "out_degree", "distance_to_prior_default"]
    dbl = ["norm_in_degree", "norm_out_degree", "pagerank", "clustering_coefficient",
           "neighbor_default_frac", "neighbor_default_frac_2hop"]
    return df.select("customer_id", *[F.bround(F.col(c).cast("double")).cast("int").alias(c) for c in ints],
                     *[F.col(c).cast("double").alias(c) for c in dbl])


def stg_relationships(edges: DataFrame) -> DataFrame:
    """Drop self-loops (and null endpoints); unknown or null types -> 'unknown'."""
    t = F.col("edge_type")
    return (edges.filter(F.col("src_customer_id") != F.col("dst_customer_id"))
            .select("src_customer_id", "dst_customer_id", "edge_type",
                    F.when(t.isin(*VALID_EDGE_TYPES), t).otherwise("unknown").alias("validated_edge_type")))


def category(c: str):
    """The class of a value: its text; a missing value is the class 'None'."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def label_classes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fitted encoders as a table: (column, class, code) with classes sorted as strings.

    The class table has one row per distinct value and column: its size is bounded
    by the categories, not by the rows, which is what makes it safe to broadcast.
    """
    from pyspark.sql import Window
    # one pass for all columns; stored, since every encoding reads the table once a column
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), category(c).alias("class"))
                                          for c in cols])).alias("p")).select("p.column", "p.class").distinct()
    w = Window.partitionBy("column").orderBy("class")
    return cut_lineage(pairs.withColumn("code", (F.row_number().over(w) - 1).cast("int")))


def label_encode(df: DataFrame, classes: DataFrame, cols: list[str], keep_unknown: bool = True) -> DataFrame:
    """Replace each categorical by its code; unknown classes become null (then rejectable).

    The class table is broadcast: a shuffle on a category would put all rows of a class into one task."""
    out = df
    for c in cols:
        m = classes.filter(F.col("column") == c).select(F.col("class").alias(f"_k_{c}"),
                                                        F.col("code").alias(f"_v_{c}"))
        out = (out.join(F.broadcast(m), category(c) == F.col(f"_k_{c}"), "left")
               .withColumn(c, F.col(f"_v_{c}")).drop(f"_k_{c}", f"_v_{c}"))
    if not keep_unknown:
        cond = None
        for c in cols:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        out = out.filter(cond)
    return out


def encode_reject(df: DataFrame, classes: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Rows whose category is not among the fitted classes: (key, column, value)."""
    out = None
    for c in cols:
        m = classes.filter(F.col("column") == c).select(F.col("class").alias("_k"))
        bad = (df.join(m, category(c) == F.col("_k"), "left_anti")
               .select(key, F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        out = bad if out is None else out.unionByName(bad)
    return out


REQUEST_RULES = [
    ("customer_id", lambda: F.col("customer_id").isNull(), "customer_id missing"),
    ("person_age", lambda: F.col("person_age").isNull() | (F.col("person_age") < AGE_MIN)
     | (F.col("person_age") > AGE_MAX), "person_age out of range"),
    ("person_income", lambda: F.col("person_income").isNull() | (F.col("person_income") <= 0),
     "person_income must be > 0"),
    ("person_home_ownership", lambda: F.col("person_home_ownership").isNull(), "person_home_ownership missing"),
    ("person_emp_length", lambda: F.col("person_emp_length").isNull() | (F.col("person_emp_length") < 0),
     "person_emp_length must be >= 0"),
    ("loan_intent", lambda: F.col("loan_intent").isNull(), "loan_intent missing"),
    ("loan_grade", lambda: F.col("loan_grade").isNull(), "loan_grade missing"),
    ("loan_amnt", lambda: F.col("loan_amnt").isNull() | (F.col("loan_amnt") <= 0), "loan_amnt must be > 0"),
    ("loan_int_rate", lambda: F.col("loan_int_rate").isNull() | (F.col("loan_int_rate") < 0),
     "loan_int_rate must be >= 0"),
    ("loan_percent_income", lambda: F.col("loan_percent_income").isNull() | (F.col("loan_percent_income") < 0),
     "loan_percent_income must be >= 0"),
    ("cb_person_cred_hist_length", lambda: F.col("cb_person_cred_hist_length").isNull()
     | (F.col("cb_person_cred_hist_length") < 0), "cb_person_cred_hist_length must be >= 0"),
    ("cb_person_default_on_file", lambda: F.col("cb_person_default_on_file").isNull()
     | ~F.col("cb_person_default_on_file").isin(0, 1), "cb_person_default_on_file must be 0 or 1"),
]


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``reasons`` (array of failed rules) and ``accepted`` (no failures).

    Every field is required: a rule whose column the input lacks fails on every row.
    """
    reasons = F.array_compact(F.array(*[
        F.when(cond() if name in df.columns else F.lit(True), F.lit(msg)) for name, cond, msg in REQUEST_RULES]))
    return df.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def validate_cascade_params(shock: float, decay: float, threshold: float, max_hops: int) -> None:
    for name, v in (("initial_shock", shock), ("decay", decay), ("threshold", threshold)):
        if not (0.0 <= v <= 1.0):
            raise ValueError(f"{name} must be in [0, 1], got {v}")
    if not (1 <= int(max_hops) <= 10):
        raise ValueError(f"max_hops must be in 1..10, got {max_hops}")
