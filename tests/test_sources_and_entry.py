"""Sources, sinks and the driver contract."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from lendnet.sources import files as SF
from lendnet.sources.sinks import dual_sink, graph_load, load_counts


def test_raw_edge_csv_with_comments_and_padding(spark):
    d = tempfile.mkdtemp(prefix="lendnet-src-")
    net = os.path.join(d, "prosper_user_loans_2016")
    os.makedirs(net)
    with open(os.path.join(net, "edges.csv"), "w") as f:
        f.write("% header-ish\n# comment line\n1 ,  2, 1, 1200000000\n 2,3 ,2,1300000000\n")
    kind, df = SF.load_source(spark, d)
    assert kind == "network"
    rows = sorted((r.src_customer_id, r.dst_customer_id, r.ts_epoch) for r in df.collect() if r.src_customer_id)
    assert ("PROSPER_1", "PROSPER_2", 1200000000) in rows and ("PROSPER_2", "PROSPER_3", 1300000000) in rows


def test_flat_source_and_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="lendnet-src-")
    with open(os.path.join(d, "credit_risk_dataset.csv"), "w") as f:
        f.write("person_age,person_income,person_home_ownership,person_emp_length,loan_intent,loan_grade,"
                "loan_amnt,loan_int_rate,loan_status,loan_percent_income,cb_person_default_on_file,"
                "cb_person_cred_hist_length\n22,59000,RENT,123.0,PERSONAL,D,35000,16.02,1,0.59,Y,3\n"
                "21,9600,OWN,,EDUCATION,B,1000,11.14,0,0.1,N,2\n")
    kind, df = SF.load_source(spark, d)
    assert kind == "flat" and df.count() == 2 and df.schema["person_income"].dataType.typeName() == "double"
    out = os.path.join(d, "out")
    SF.write_csv(df, out)
    back = SF.read_customers_csv(spark, out)
    assert sorted(back.collect()) == sorted(df.collect())


def test_replace_table_and_views(spark):
    import uuid
    name = f"lendnet_tmp_{uuid.uuid4().hex[:8]}"
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    SF.replace_table(df, name)
    SF.replace_table(df.limit(3), name)
    assert spark.table(name).count() == 3
    SF.register_sources({"lendnet_v": df})
    assert spark.sql("select count(*) as n from lendnet_v").first().n == 5


def test_graph_load_keeps_edges_with_both_endpoints(spark):
    c = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "customer_id string, person_age int") \
        .withColumns({k: F.lit(None) for k in ["person_income", "loan_amnt", "loan_status",
                                                "cb_person_default_on_file", "loan_intent"]})
    e = spark.createDataFrame([(0, "A", "B", "loan"), (1, "A", "Z", "loan")],
                              "edge_ord long, src_customer_id string, dst_customer_id string, edge_type string")
    nodes, kept = graph_load(c, e)
    assert nodes.count() == 2 and kept.count() == 1
    counts = {r.table_name: (r.submitted, r.kept) for r in load_counts(c, e).collect()}
    assert counts == {"customers": (3, 2), "relationships": (2, 1)}


def test_dual_sink_is_idempotent_per_batch(spark):
    d = tempfile.mkdtemp(prefix="lendnet-sink-")
    b = spark.range(4)
    dual_sink(b, 0, os.path.join(d, "a"), os.path.join(d, "b"))
    dual_sink(b, 0, os.path.join(d, "a"), os.path.join(d, "b"))   # replay of batch 0
    assert spark.read.parquet(os.path.join(d, "a")).count() == 4
    assert spark.read.parquet(os.path.join(d, "b")).count() == 4


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "interest_rate_risk_band" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_materialisations(spark, tmp_path):
    import pytest
    from lendnet.sources.files import materialize_model
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert materialize_model(df, "mat_view", "view").count() == 2
    path = str(tmp_path / "inc")
    materialize_model(df, "mat_inc", "incremental", path, "k", 0)
    more = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    for _ in range(2):          # a replay of the same version changes nothing
        got = materialize_model(more, "mat_inc", "incremental", path, "k", 1)
        assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        materialize_model(more.withColumn("k", more.k.cast("int")), "mat_inc", "incremental", path, "k", 2)
