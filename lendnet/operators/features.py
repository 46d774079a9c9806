"""Feature mart, derived features, lookups and scorecard formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.functions.columns import clip, rate_band, sigmoid
from lendnet.schemas import GRAPH_FEATURES

MART_CUSTOMER_COLS = [
    "customer_id", "person_age", "person_income", "person_home_ownership", "person_emp_length",
    "loan_intent", "loan_grade", "loan_amnt", "loan_int_rate", "loan_status", "loan_percent_income",
    "cb_person_default_on_file", "cb_person_cred_hist_length", "is_recent_default",
]


def fct_credit_features(stg_customers: DataFrame, stg_graph: DataFrame,
                        with_load_time: bool = False) -> DataFrame:
    """Staged customers left-joined to staged graph features, plus the rate band."""
    c = stg_customers.select(*MART_CUSTOMER_COLS)
    j = c.join(stg_graph.select("customer_id", *GRAPH_FEATURES), "customer_id", "left")
    out = j.select(*MART_CUSTOMER_COLS, rate_band("loan_int_rate").alias("interest_rate_risk_band"),
                   *GRAPH_FEATURES)
    if with_load_time:
        out = out.withColumn("_loaded_at", F.current_timestamp())
    return out


def derived_features(df: DataFrame) -> DataFrame:
    """The seven derived columns shared by training and scoring (income 0 -> null dti)."""
    dti = F.try_divide(F.col("loan_amnt"), F.col("person_income"))
    return (df.withColumn("dti", dti).withColumns({
        "norm_in_x_dti": F.col("norm_in_degree") * F.col("dti"),
        "norm_in_x_nbr_def": F.col("norm_in_degree") * F.col("neighbor_default_frac"),
        "dti_x_cb_default": F.col("dti") * F.col("cb_person_default_on_file"),
        "int_rate_x_dti": F.col("loan_int_rate") * F.col("dti"),
        "degree_ratio": F.col("in_degree") / (F.col("out_degree") + F.lit(1.0)),
        "income_log": F.log1p("person_income"),
    }))


def contagion_logit(df: DataFrame) -> DataFrame:
    """The network scorecard's logit (no noise term) and its probability."""
    dti = F.try_divide(F.col("loan_amnt"), F.col("person_income"))
    logit = (F.lit(-3.0) + F.lit(3.0) * F.col("norm_in_degree") - F.lit(1.5) * F.col("norm_out_degree")
             + F.lit(2.5) * dti + F.lit(1.2) * F.col("cb_person_default_on_file")
             - F.lit(0.6) * (F.col("cb_person_cred_hist_length") / F.lit(30.0))
             + F.lit(0.8) * F.col("crisis_exposure") + F.lit(2.0) * F.col("neighbor_default_frac")
             + F.lit(1.5) * F.col("neighbor_default_frac_2hop") + F.lit(2.0) * F.col("norm_in_degree") * dti)
    return df.withColumn("logit", logit).withColumn("default_prob", sigmoid("logit"))


def prior_default_prob(df: DataFrame) -> DataFrame:
    """clip(0.1 + 0.15 norm_in - 0.1 net_ratio + 0.1 crisis, 0.02, 0.5)."""
    p = (F.lit(0.1) + F.lit(0.15) * F.col("norm_in_degree") - F.lit(0.1) * F.col("net_ratio")
         + F.lit(0.1) * F.col("crisis_exposure"))
    return df.withColumn("prior_default_prob", clip(p, 0.02, 0.5))


def standardize(df: DataFrame, cols: list[str], eps: float = 1e-8) -> DataFrame:
    """(x - mean) / (population sd + eps), all statistics from one scalar subquery."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                            *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
    return df.withColumns({
        c: (F.col(c) - stats.getField(f"m_{c}")) / (stats.getField(f"s_{c}") + F.lit(eps)) for c in cols})


GRAPH_SENTINEL = {"degree": 0, "pagerank": 0.0, "distance_to_prior_default": -1, "clustering_coefficient": 0.0}
GRAPH_DEFAULTS = {"degree": 0, "in_degree": 0, "out_degree": 0, "norm_in_degree": 0.0, "norm_out_degree": 0.0,
                  "pagerank": 0.0, "distance_to_prior_default": -1, "clustering_coefficient": 0.0,
                  "neighbor_default_frac": 0.0, "neighbor_default_frac_2hop": 0.0}


def with_graph_defaults(df: DataFrame) -> DataFrame:
    """Requests without graph columns get the request defaults (0 / 0.0 / -1)."""
    missing = {c: F.lit(v) for c, v in GRAPH_DEFAULTS.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def graph_lookup(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose graph fields sit at the sentinel defaults take the stored features
    (all ten) when the customer has a stored row; otherwise the given values stay."""
    req = with_graph_defaults(requests)
    s = stored.select("customer_id", *[F.col(c).alias(f"_g_{c}") for c in GRAPH_FEATURES],
                      F.lit(True).alias("_g_hit"))
    j = req.join(s, "customer_id", "left")
    at_default = None
    for c, v in GRAPH_SENTINEL.items():
        cond = F.col(c) == F.lit(v)
        at_default = cond if at_default is None else at_default & cond
    take = at_default & F.col("_g_hit").isNotNull()
    j = j.withColumns({c: F.when(take, F.col(f"_g_{c}")).otherwise(F.col(c)) for c in GRAPH_FEATURES})
    return j.drop("_g_hit", *[f"_g_{c}" for c in GRAPH_FEATURES])


def bind_embeddings(features: DataFrame, embeddings: DataFrame, key: str, emb_key: str,
                    col: str = "embedding") -> DataFrame:
    """C11: every row of ``features`` with its embedding as array<double>, matched on a key; rows without
    one get zeros of the table's width."""
    width = embeddings.agg(F.coalesce(F.max(F.size(col)), F.lit(0))).scalar()
    e = embeddings.select(F.col(emb_key).alias("_emb_key"), F.col(col).cast("array<double>").alias("_emb"))
    j = features.join(e, F.col(key) == F.col("_emb_key"), "left")
    return j.withColumn(col, F.coalesce("_emb", F.array_repeat(F.lit(0.0), width.cast("int")))).drop("_emb_key", "_emb")


def induced_subgraph(customers: DataFrame, edges: DataFrame, n: int, order_col: str = "row_ord"):
    """The first ``n`` customers by ``order_col`` and the edges between them.

    ``n`` is the feature (a head-n subgraph); the kept-id table is joined, not collected.
    """
    first = customers.orderBy(order_col, "customer_id").limit(n)
    ids = first.select("customer_id")
    kept = (edges.join(ids.withColumnRenamed("customer_id", "src_customer_id"), "src_customer_id", "left_semi")
            .join(ids.withColumnRenamed("customer_id", "dst_customer_id"), "dst_customer_id", "left_semi"))
    return first, kept


def edge_typing(pairs: DataFrame, customers: DataFrame) -> DataFrame:
    """Same home -> co-borrower, else same intent -> employer, else guarantor."""
    a = customers.select(F.col("customer_id").alias("src_customer_id"),
                         F.col("person_home_ownership").alias("h1"), F.col("loan_intent").alias("i1"))
    b = customers.select(F.col("customer_id").alias("dst_customer_id"),
                         F.col("person_home_ownership").alias("h2"), F.col("loan_intent").alias("i2"))
    j = pairs.join(a, "src_customer_id").join(b, "dst_customer_id")
    t = (F.when(F.col("h1") == F.col("h2"), "co-borrower").when(F.col("i1") == F.col("i2"), "employer")
         .otherwise("guarantor"))
    return j.select("src_customer_id", "dst_customer_id", t.alias("edge_type"))
