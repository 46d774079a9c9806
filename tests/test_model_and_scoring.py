"""Scoring goldens restated from the reference (bands, rejects, factor order, feature order)
plus a small boosted-tree training run."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lendnet.functions.columns import decision_band
from lendnet.operators import clean as CL, model as MD
from lendnet.operators.order import stratified_split
from lendnet.schemas import FEATURES


def test_feature_order():
    assert FEATURES == [
        "person_age", "person_income", "person_home_ownership", "person_emp_length", "loan_intent", "loan_grade",
        "loan_amnt", "loan_int_rate", "loan_percent_income", "cb_person_default_on_file",
        "cb_person_cred_hist_length", "crisis_exposure", "degree", "in_degree", "out_degree", "norm_in_degree",
        "norm_out_degree", "pagerank", "distance_to_prior_default", "clustering_coefficient",
        "neighbor_default_frac", "neighbor_default_frac_2hop", "dti", "norm_in_x_dti", "norm_in_x_nbr_def",
        "dti_x_cb_default", "int_rate_x_dti", "degree_ratio", "income_log"]


def test_bands(spark):
    df = spark.createDataFrame([(0.7,), (0.15,), (0.35,)], "p double")
    assert [r.b for r in df.select(decision_band("p", 0.5).alias("b")).collect()] == ["high", "low", "medium"]


def test_rejects(spark):
    rows = [("C1", 30, 50000.0, "RENT", 2.0, "EDUCATION", "A", 1000.0, 10.0, 0),
            (None, 30, 50000.0, "RENT", 2.0, "EDUCATION", "A", 1000.0, 10.0, 0),
            ("C3", 30, -5.0, "RENT", 2.0, "EDUCATION", "A", 1000.0, 10.0, 0),
            ("C4", 30, 50000.0, "RENT", 2.0, "EDUCATION", "Z", 1000.0, 10.0, 0)]
    df = spark.createDataFrame(rows, "customer_id string, person_age int, person_income double, "
                               "person_home_ownership string, person_emp_length double, loan_intent string, "
                               "loan_grade string, loan_amnt double, loan_int_rate double, "
                               "cb_person_default_on_file int").withColumn("application_id", F.monotonically_increasing_id())
    # every field of the request is required: without two of them nothing is accepted
    assert not any(r.accepted for r in CL.validate_requests(df).collect())
    df = df.withColumns({"loan_percent_income": F.lit(0.1), "cb_person_cred_hist_length": F.lit(3)})
    low = df.withColumn("loan_percent_income", F.lit(-1.0))
    assert not any(r.accepted for r in CL.validate_requests(low).collect())
    v = {r.customer_id: r.accepted for r in CL.validate_requests(df).collect()}
    assert v["C1"] and not v[None] and not v["C3"]
    classes = CL.label_classes(df.filter(F.col("loan_grade") == "A"), ["loan_grade"])
    bad = CL.encode_reject(df, classes, ["loan_grade"], "customer_id").collect()
    assert [r.value for r in bad] == ["Z"]


def test_top_factors_sorted_by_abs(spark):
    df = spark.createDataFrame([([("a", 0.1), ("b", -0.9), ("c", 0.5), ("d", 0.0)],)],
                               "factors array<struct<feature:string,shap_value:double>>")
    top = MD.top_factors(df, n=3).collect()[0].top_factors
    assert [t.feature for t in top] == ["b", "c", "a"]


def test_factor_json_round_trip(spark):
    df = spark.createDataFrame([([("a", 0.0001), ("b", -2.5)],)], "top_factors array<struct<feature:string,shap_value:double>>")
    back = df.select(MD.factors_to_json().alias("top_factors")).select(MD.factors_from_json().alias("x"))
    assert [(r.feature, r.shap_value) for r in back.collect()[0].x] == [("a", 0.0001), ("b", -2.5)]


def test_gbt_trains_and_beats_chance(spark):
    from lendnet.operators.graph.features import graph_features
    from lendnet.operators.metrics import roc_auc
    from lendnet.plans.q_clean import clean_view
    from lendnet.sources import fixtures as FX
    gf = graph_features(FX.customers(spark, SF001), FX.edges(spark, SF001))
    data, _ = MD.assemble_features(clean_view(spark, SF001), gf)
    # the fixture's loan_status carries no signal at this size; test the trainer on a
    # label that is a function of the features (income above its median)
    med = data.agg(F.median("person_income")).first()[0]
    data = data.withColumn("label", (F.col("person_income") > med).cast("int"))
    split = stratified_split(data, "label", "customer_id", 42)
    model = MD.train_gbt(split.filter(F.col("split") == "train"), max_iter=10, max_depth=3)
    pred = MD.predict_proba(model, split.filter(F.col("split") == "test"))
    auc = roc_auc(pred.select(F.col("label").alias("y"), F.col("risk_score").alias("p"))).first()[0]
    assert auc > 0.8


def test_stratified_split_exact_counts(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    s = stratified_split(df, "y", "id", 7)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert counts[(1, "test")] == 40 and counts[(0, "test")] == 160


def test_cascade_parameter_validation():
    with pytest.raises(ValueError):
        CL.validate_cascade_params(1.5, 0.5, 0.3, 3)
    with pytest.raises(ValueError):
        CL.validate_cascade_params(1.0, 0.5, 0.3, 11)
    CL.validate_cascade_params(1.0, 0.5, 0.3, 10)


def test_run_metrics_append(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="lendnet-runs-")
    m = spark.createDataFrame([(0.8, 0.7)], "roc_auc double, f1 double")
    MD.append_run_metrics("r1", {"max_depth": 4}, m, d)
    MD.append_run_metrics("r2", {"max_depth": 5}, m, d)
    assert spark.read.parquet(f"{d}/metrics").count() == 4
    assert spark.read.parquet(f"{d}/params").count() == 2


def test_event_stamping(spark):
    from lendnet.operators.events import stamp_events
    df = stamp_events(spark.range(3).select(F.col("id").alias("customer_id")))
    rows = df.collect()
    assert len({r.scoring_event_id for r in rows}) == 3 and all(r.scored_at is not None for r in rows)


def test_hybrid_comparison_reports_both_models(spark):
    from lendnet.operators.graph.features import graph_features
    from lendnet.operators.graph.spectral import spectral_embedding
    from lendnet.plans.q_clean import clean_view
    from lendnet.sources import fixtures as FX
    cust, edges = FX.customers(spark, SF001), FX.edges(spark, SF001)
    data, _ = MD.assemble_features(clean_view(spark, SF001), graph_features(cust, edges))
    med = data.agg(F.median("person_income")).first()[0]
    data = stratified_split(data.withColumn("label", (F.col("person_income") > med).cast("int")), "label",
                            "customer_id", 42)
    emb, _ = spectral_embedding(cust, edges, dim=2, iters=10)
    res = {r.model: r for r in MD.compare_hybrid(data, emb, max_iter=5, max_depth=3).collect()}
    assert set(res) == {"vanilla", "hybrid"}
    assert abs(res["hybrid"].auc_delta - (res["hybrid"].roc_auc - res["vanilla"].roc_auc)) < 1e-12


def test_features_from_flat_source(spark):
    import os
    import tempfile
    from lendnet.operators.graph.features import features_from_source
    d = tempfile.mkdtemp(prefix="lendnet-h9-")
    rows = ["person_age,person_income,person_home_ownership,person_emp_length,loan_intent,loan_grade,loan_amnt,"
            "loan_int_rate,loan_status,loan_percent_income,cb_person_default_on_file,cb_person_cred_hist_length"]
    for i in range(40):
        rows.append(f"{20 + i},{20000 + 1000 * i},{['RENT', 'OWN'][i % 2]},{i % 7},{['EDU', 'MED', 'VEN'][i % 3]},"
                    f"{'ABC'[i % 3]},{1000 + 10 * i},{10 + i % 5},{i % 2},0.1,{'YN'[i % 2]},{i % 9 + 1}")
    with open(os.path.join(d, "credit_risk_dataset.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")
    gf = features_from_source(spark, d)
    assert gf.count() == 40 and len(gf.columns) == 11


def test_tree_contributions_add_up_to_the_margin(spark):
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from lendnet.operators.trees import base_margin, gbt_nodes, tree_contrib
    rng = np.random.default_rng(1)
    cols = ["a", "b", "c"]
    rows = [(float(x), float(y), float(z), float(x * y > 0.2 or z > 0.8)) for x, y, z in rng.random((400, 3))]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    model = MD.train_gbt(df, cols=cols, max_iter=5, max_depth=3)
    nodes = gbt_nodes(model)
    got = tree_contrib(df, nodes, cols)
    p = model.transform(MD.vectorize(got, cols)).select(
        "margin", "factors", vector_to_array("probability")[1].alias("p")).collect()
    for r in p:
        assert abs(1 / (1 + np.exp(-2 * r.margin)) - r.p) < 1e-9
        assert abs(base_margin(nodes) + sum(f.shap_value for f in r.factors) - r.margin) < 1e-9


def test_score_applications_with_trained_model(spark):
    from lendnet.operators.graph.features import graph_features
    from lendnet.plans.q_clean import clean_view
    from lendnet.schemas import CAT_COLS
    from lendnet.sources import fixtures as FX
    gf = graph_features(FX.customers(spark, SF001), FX.edges(spark, SF001))
    data, classes = MD.assemble_features(clean_view(spark, SF001), gf)
    model = MD.train_gbt(data, max_iter=3, max_depth=3)
    apps = FX.applications(spark, SF001)
    events, rejects = MD.score_applications(apps, classes, gf, 0.441, model=model)
    rows = events.collect()
    assert len(rows) + rejects.count() == apps.count() and rows
    assert all(0 <= r.risk_score <= 1 and len(r._factors) == 5 for r in rows)


def test_null_category_is_a_class(spark):
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "g string")
    classes = CL.label_classes(df, ["g"])
    assert {r["class"]: r["code"] for r in classes.collect()} == {"None": 0, "X": 1, "Y": 2}
    assert sorted(r.g for r in CL.label_encode(df, classes, ["g"]).collect()) == [0, 1, 2]


def test_auc_of_very_large_counts(spark):
    from lendnet.operators import metrics
    from unittest import mock
    h = spark.createDataFrame([(0.2, 1, 4_000_000_000), (0.8, 4_000_000_000, 1)], "score double, pos long, neg long")
    with mock.patch.object(metrics, "score_histogram", lambda *a, **k: h):
        assert metrics.roc_auc(h).first()[0] > 0.999


def test_split_keeps_rows_without_a_label(spark):
    from lendnet.operators.order import stratified_split
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(30)], "id long, y long")
    out = stratified_split(df, "y", "id").collect()
    assert len(out) == 30 and sum(r.split == "train" for r in out if r.y is None) == 8


def test_run_metrics_of_a_retried_run(spark, tmp_path):
    m = spark.createDataFrame([(0.8,)], "roc_auc double")
    for _ in range(2):
        MD.append_run_metrics("r1", {"depth": 4}, m, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/metrics").count() == 1


def test_session_leaves_the_clusters_partition_count():
    from unittest import mock
    from lendnet import session
    seen = {}

    class Builder:
        def __getattr__(self, name):
            def step(*a):
                seen.setdefault(name, []).append(a)
                return mock.MagicMock() if name == "getOrCreate" else self
            return step
    with mock.patch.object(session.SparkSession, "builder", Builder()), mock.patch.object(session, "ensure_checkpoint_dir"):
        session.get_session()
        assert not any(a[0] == "spark.sql.shuffle.partitions" for a in seen["config"])
        session.get_session("local[4]")
        assert ("spark.sql.shuffle.partitions", "8") in seen["config"]


def test_gbt_evaluate_trains_with_the_operator_defaults(spark, monkeypatch):
    from conftest import SF001
    from lendnet.plans import q_model as Q
    models, train = [], Q.MD.train_gbt
    monkeypatch.setattr(Q.MD, "train_gbt", lambda *a, **kw: models.append(train(*a, **kw)) or models[-1])
    assert Q.gbt_evaluate(spark, SF001).count() > 0
    assert [(m.getMaxIter(), m.getMaxDepth()) for m in models] == [(20, 5)]


def test_encoding_does_not_shuffle_rows_by_category(spark):
    from lendnet.operators import clean as CL
    df = spark.createDataFrame([(i, "ABC"[i % 3], None if i % 4 else "x") for i in range(12)], "id int, g string, h string")
    classes = CL.label_classes(df, ["g", "h"])
    assert sorted(tuple(r) for r in classes.collect()) == [("g", "A", 0), ("g", "B", 1), ("g", "C", 2),
                                                           ("h", "None", 0), ("h", "x", 1)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enc = CL.label_encode(df, classes, ["g", "h"])
        assert "SortMergeJoin" not in enc._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id, r.g, r.h) for r in enc.collect()) == [(i, i % 3, 0 if i % 4 else 1) for i in range(12)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
