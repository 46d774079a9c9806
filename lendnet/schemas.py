"""Fixed schemas, feature order and constants.

The values below must equal the reference's for the results to match; they are
stated as plain fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Categorical columns label-encoded before training.
CAT_COLS = ["person_home_ownership", "loan_intent", "loan_grade"]

# Tabular features, in model order.
TABULAR_FEATURES = [
    "person_age", "person_income", "person_home_ownership", "person_emp_length",
    "loan_intent", "loan_grade", "loan_amnt", "loan_int_rate", "loan_percent_income",
    "cb_person_default_on_file", "cb_person_cred_hist_length", "crisis_exposure",
]

# Graph features, in model order.
GRAPH_FEATURES = [
    "degree", "in_degree", "out_degree", "norm_in_degree", "norm_out_degree", "pagerank",
    "distance_to_prior_default", "clustering_coefficient", "neighbor_default_frac",
    "neighbor_default_frac_2hop",
]

# Derived features, in model order.
DERIVED_FEATURES = [
    "dti", "norm_in_x_dti", "norm_in_x_nbr_def", "dti_x_cb_default", "int_rate_x_dti",
    "degree_ratio", "income_log",
]

FEATURES = TABULAR_FEATURES + GRAPH_FEATURES + DERIVED_FEATURES  # 29 columns
TARGET = "loan_status"

# Stress each relationship type transmits; any other type transmits 1.0.
EDGE_STRESS = {"co-borrower": 1.0, "guarantor": 0.7, "employer": 0.4, "loan": 1.0}

# Relationship types accepted by the staging model; others become 'unknown'.
VALID_EDGE_TYPES = ["co-borrower", "guarantor", "employer", "loan"]

# Grades, best to worst.
GRADES = ["A", "B", "C", "D", "E", "F", "G"]

# Decision threshold used by the scoring service and its band edges (t/2, t).
DEFAULT_THRESHOLD = 0.441

# Promotion gate on ROC-AUC.
AUC_GATE = 0.72

# Crisis window of the lending network (inclusive), and the time given to nodes
# without edges (inside the window, so such nodes score 1.0).
CRISIS_START = 1167609600  # 2007-01-01, unix seconds
CRISIS_END = 1262304000  # 2010-01-01, unix seconds
MISSING_TS = 1.2e9

# Dashboard severity steps: (metric, amber at, red at); AUC is reversed (low is bad).
GAUGE_STEPS = {
    "auc": (0.7, 0.6),
    "drifted_columns": (1.0, 3.0),
    "drift_share": (0.15, 0.4),
    "error_ratio": (0.01, 0.05),
}

# Request bounds of the scoring endpoint.
AGE_MIN, AGE_MAX = 18, 100
# ------------------------------------------------------------ end fixed values

CUSTOMER_CSV_SCHEMA = T.StructType([
    T.StructField("person_age", T.IntegerType()),
    T.StructField("person_income", T.DoubleType()),
    T.StructField("person_home_ownership", T.StringType()),
    T.StructField("person_emp_length", T.DoubleType()),
    T.StructField("loan_intent", T.StringType()),
    T.StructField("loan_grade", T.StringType()),
    T.StructField("loan_amnt", T.DoubleType()),
    T.StructField("loan_int_rate", T.DoubleType()),
    T.StructField("loan_status", T.IntegerType()),
    T.StructField("loan_percent_income", T.DoubleType()),
    T.StructField("cb_person_default_on_file", T.StringType()),
    T.StructField("cb_person_cred_hist_length", T.IntegerType()),
])

RAW_EDGE_SCHEMA = T.StructType([
    T.StructField("source", T.LongType()),
    T.StructField("target", T.LongType()),
    T.StructField("weight", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("edge_ord", T.LongType()),
    T.StructField("src_customer_id", T.StringType()),
    T.StructField("dst_customer_id", T.StringType()),
    T.StructField("edge_type", T.StringType()),
])

GRAPH_FEATURE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("degree", T.IntegerType()),
    T.StructField("in_degree", T.IntegerType()),
    T.StructField("out_degree", T.IntegerType()),
    T.StructField("norm_in_degree", T.DoubleType()),
    T.StructField("norm_out_degree", T.DoubleType()),
    T.StructField("pagerank", T.DoubleType()),
    T.StructField("distance_to_prior_default", T.IntegerType()),
    T.StructField("clustering_coefficient", T.DoubleType()),
    T.StructField("neighbor_default_frac", T.DoubleType()),
    T.StructField("neighbor_default_frac_2hop", T.DoubleType()),
])

FACTOR_TYPE = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("shap_value", T.DoubleType()),
]))

SCORING_EVENT_SCHEMA = T.StructType([
    T.StructField("scoring_event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("decision_band", T.StringType()),
    T.StructField("requested_amount", T.DoubleType()),
    T.StructField("top_factors", T.StringType()),
    T.StructField("scored_at", T.TimestampType()),
])
