"""Model jobs: feature assembly, Spark ML training, batch scoring, attributions.

Scoring works on a whole applications table (or a stream) with the same steps as
one request: validate -> encode with fitted classes -> graph lookup -> derived
features -> model -> band -> top factors -> event rows. The lookup is one join
instead of a point read per request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendnet.functions.columns import decision_band, sigmoid
from lendnet.operators.clean import label_classes, label_encode, validate_requests
from lendnet.operators.features import derived_features, graph_lookup, with_graph_defaults
from lendnet.operators.trees import gbt_nodes, tree_contrib
from lendnet.schemas import CAT_COLS, FACTOR_TYPE, FEATURES, GRAPH_FEATURES, TARGET
from lendnet.session import cut_lineage

# ---------------------------------------------------------------- fixed values
# Linear scorecard used for the checkable scoring job (intercept, then feature -> weight).
SCORECARD_INTERCEPT = -3.0
SCORECARD = {
    "norm_in_degree": 3.0, "norm_out_degree": -1.5, "dti": 2.5, "cb_person_default_on_file": 1.2,
    "neighbor_default_frac": 2.0, "neighbor_default_frac_2hop": 1.5, "norm_in_x_dti": 2.0,
    "loan_int_rate": 0.05, "person_age": -0.01,
}
# ------------------------------------------------------------ end fixed values


def assemble_features(clean_customers: DataFrame, graph_feats: DataFrame,
                      classes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Customers + graph features, label-encoded categoricals, derived columns.

    Returns (frame with customer_id, the 29 features in order and the label; class table).
    """
    j = clean_customers.join(graph_feats.select("customer_id", *GRAPH_FEATURES), "customer_id", "left")
    if classes is None:
        classes = label_classes(clean_customers, CAT_COLS)     # the left join adds no category
    enc = derived_features(label_encode(j, classes, CAT_COLS))
    return enc.select("customer_id", *FEATURES, F.col(TARGET).alias("label")), classes


def vectorize(df: DataFrame, cols: list[str] = FEATURES, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def train_gbt(train: DataFrame, label: str = "label", seed: int = 42, max_iter: int = 20, max_depth: int = 5,
              step_size: float = 0.1, subsample: float = 0.8, validation_col: str | None = None,
              cols: list[str] = FEATURES):
    """Boosted trees with the positive class weighted by neg/pos; optional early stop
    on a validation indicator column."""
    from pyspark.ml.classification import GBTClassifier
    counts = train.agg(F.sum((F.col(label) == 0).cast("long")).alias("neg"),
                       F.sum((F.col(label) == 1).cast("long")).alias("pos"))
    w = F.when(counts.select("pos").scalar() > 0,
               counts.select("neg").scalar() / counts.select("pos").scalar()).otherwise(F.lit(1.0))
    data = vectorize(train, cols).withColumn("weight", F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample, seed=seed,
                        featureSubsetStrategy="all", minInstancesPerNode=3, minInfoGain=0.0)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    return gbt.fit(data)


def predict_proba(model, df: DataFrame, out: str = "risk_score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.transform(vectorize(df)).withColumn(out, vector_to_array("probability")[1])


def scorecard_score(df: DataFrame, coefs: dict[str, float] = SCORECARD,
                    intercept: float = SCORECARD_INTERCEPT) -> DataFrame:
    logit = F.lit(intercept)
    for f, c in coefs.items():
        logit = logit + F.lit(c) * F.col(f)
    return df.withColumn("risk_score", sigmoid(logit))


def linear_contrib(df: DataFrame, coefs: dict[str, float] = SCORECARD, baseline: DataFrame | None = None,
                   out: str = "factors") -> DataFrame:
    """Exact attributions of a linear model, coef * (x - E[x]) (baseline means from one scalar
    subquery), as an array<struct<feature, shap_value>> column."""
    if baseline is not None:
        # fitted baseline (e.g. the training table): its k means are model parameters
        row = baseline.agg(*[F.avg(f).alias(f) for f in coefs]).first()
        mean = {f: F.lit(row[f]) for f in coefs}
    else:
        means = df.agg(F.struct(*[F.avg(f).alias(f) for f in coefs])).scalar()
        mean = {f: means.getField(f) for f in coefs}
    items = [F.struct(F.lit(f).alias("feature"), (F.lit(c) * (F.col(f) - mean[f])).alias("shap_value"))
             for f, c in coefs.items()]
    return df.withColumn(out, F.array(*items))


def top_factors(df: DataFrame, col: str = "factors", n: int = 5, out: str = "top_factors") -> DataFrame:
    """Top-n entries by |value| descending (ties: feature name), per row - no shuffle."""
    srt = F.array_sort(col, lambda a, b: F.when(F.abs(a["shap_value"]) > F.abs(b["shap_value"]), -1)
                       .when(F.abs(a["shap_value"]) < F.abs(b["shap_value"]), 1)
                       .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))
    return df.withColumn(out, F.slice(srt, 1, n))


def factors_to_json(col: str = "top_factors"):
    return F.to_json(F.col(col))


def factors_from_json(col: str = "top_factors"):
    return F.from_json(F.col(col), FACTOR_TYPE)


def global_importance(contrib: DataFrame, col: str = "factors") -> DataFrame:
    """Mean |contribution| per feature, ranked (1 = most important)."""
    long = contrib.select(F.explode(col).alias("f")).select("f.feature", F.abs("f.shap_value").alias("a"))
    # one row per feature: the window sees a handful of rows
    w = Window.orderBy(F.col("mean_abs").desc(), "feature")
    return long.groupBy("feature").agg(F.avg("a").alias("mean_abs")).withColumn("rank", F.row_number().over(w))


def encode_requests(apps: DataFrame, classes: DataFrame) -> DataFrame:
    """Validated and encoded applications with ``reasons`` and ``accepted``: a broken rule or a category
    unknown to ``classes`` refuses a row."""
    v = validate_requests(apps)
    unknown = F.array_compact(F.array(*[F.when(F.col(c).isNull() & F.col(f"_raw_{c}").isNotNull(),
                                               F.lit(f"unknown category for {c}")) for c in CAT_COLS]))
    return (v.withColumns({f"_raw_{c}": F.col(c) for c in CAT_COLS})
            .transform(lambda d: label_encode(d, classes, CAT_COLS))
            .withColumn("reasons", F.concat("reasons", unknown))
            .withColumn("accepted", F.size("reasons") == 0))


def rejected(enc: DataFrame, id_col: str = "application_id") -> DataFrame:
    return enc.filter(~F.col("accepted")).select(id_col, "customer_id", "reasons")


def score_applications(apps: DataFrame, classes: DataFrame, stored_graph: DataFrame,
                       threshold: float, id_col: str = "application_id", ts_col: str = "applied_at",
                       coefs: dict[str, float] = SCORECARD,
                       baseline: DataFrame | None = None,
                       materialize: bool = True, model=None) -> tuple[DataFrame, DataFrame]:
    """(events, rejects). Events carry risk, band, JSON top factors, amount and time.

    With ``model`` (a fitted boosted-trees classifier over ``FEATURES``) the risk is its probability and
    the factors are tree path contributions; without it the linear scorecard is used.

    Rejects are rows failing validation or carrying a category unknown to ``classes``.
    """
    enc = encode_requests(apps, classes)
    rejects = rejected(enc, id_col)
    ok = enc.filter(F.col("accepted"))
    feat = derived_features(graph_lookup(with_graph_defaults(ok), stored_graph))
    if model is not None:
        scored = tree_contrib(feat, gbt_nodes(model), FEATURES)
        attributed = top_factors(scored.withColumn("risk_score", sigmoid(F.lit(2.0) * F.col("margin"))))
    else:
        # the scored table feeds the attribution means and the events: materialise it once
        scored = scorecard_score(feat, coefs)
        if materialize:          # batch only: a streaming plan cannot be checkpointed mid-query
            used = [id_col, "customer_id", "risk_score", "loan_amnt", ts_col]
            scored = cut_lineage(scored.select(*used, *[f for f in coefs if f not in used]))
        attributed = top_factors(linear_contrib(scored, coefs, baseline))
    events = attributed.select(
        F.col(id_col).cast("string").alias("scoring_event_id"), "customer_id", "risk_score",
        decision_band("risk_score", threshold).alias("decision_band"),
        F.col("loan_amnt").alias("requested_amount"), factors_to_json().alias("top_factors"),
        F.col(ts_col).alias("scored_at"), F.col("top_factors").alias("_factors"))
    return events, rejects


def append_run_metrics(run_id: str, params: dict, metrics: DataFrame, path: str) -> None:
    """One run's parameters and metrics (long format), kept under the run's id: a retried run
    replaces its own rows instead of logging twice."""
    spark = metrics.sparkSession
    long = metrics.unpivot([], [c for c in metrics.columns], "metric", "value").select(
        F.lit(run_id).alias("run_id"), "metric", F.col("value").cast("double").alias("value"))
    prm = spark.createDataFrame([(run_id, k, str(v)) for k, v in sorted(params.items())],
                                "run_id string, param string, value string")
    long.withColumn("logged_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/metrics/run={run_id}")
    prm.withColumn("logged_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/params/run={run_id}")


def compare_hybrid(data: DataFrame, embeddings: DataFrame, split_col: str = "split", label: str = "label",
                   max_iter: int = 10, max_depth: int = 4, seed: int = 42) -> DataFrame:
    """AUC of boosted trees on the 29 features vs. the same plus embedding columns,
    on the same split. ``embeddings``: (customer_id, embedding array<double>)."""
    from lendnet.operators.metrics import roc_auc
    dim = embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0
    ecols = [f"emb_{i}" for i in range(dim)]
    hyb = data.join(embeddings, "customer_id", "left").withColumns(
        {c: F.coalesce(F.col("embedding")[i], F.lit(0.0)) for i, c in enumerate(ecols)})
    out = []
    for name, df, cols in (("vanilla", data, FEATURES), ("hybrid", hyb, FEATURES + ecols)):
        tr = df.filter(F.col(split_col) == "train")
        te = df.filter(F.col(split_col) == "test")
        model = train_gbt(tr, label=label, cols=cols, max_iter=max_iter, max_depth=max_depth, seed=seed)
        pred = predict_proba_cols(model, te, cols)
        auc = roc_auc(pred.select(F.col(label).alias("y"), F.col("risk_score").alias("p"))).first()[0]
        out.append((name, float(auc)))
    spark = data.sparkSession
    res = spark.createDataFrame(out, "model string, roc_auc double")
    return res.withColumn("auc_delta", F.lit(out[1][1] - out[0][1]))


def predict_proba_cols(model, df: DataFrame, cols: list[str], out: str = "risk_score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.transform(vectorize(df, cols)).withColumn(out, vector_to_array("probability")[1])
