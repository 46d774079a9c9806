"""Scans, projections, cleaning and staging queries (survey §2.A, §2.B)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendnet.functions import columns as C
from lendnet.operators import clean as CL
from lendnet.operators.order import with_row_ids
from lendnet.plans.catalog import query, rnd
from lendnet.session import ensure_checkpoint_dir
from lendnet.sources import fixtures as FX
from lendnet.sources.fixtures import with_views

# Cleaned customers as a CTE body (over the ``customers`` view).
CLEAN_SQL = """
select customer_id, row_ord, least(person_age, 100) as person_age,
 least(person_income, 500000e0) as person_income, person_home_ownership,
 coalesce(person_emp_length, (select median(person_emp_length) from customers)) as person_emp_length,
 loan_intent, loan_grade, loan_amnt,
 coalesce(loan_int_rate, (select median(loan_int_rate) from customers)) as loan_int_rate,
 loan_status,
 cast(case when coalesce(cb_person_default_on_file, '') = 'Y' then 1 else 0 end as int) as cb_person_default_on_file,
 cb_person_cred_hist_length,
 round(greatest(least(loan_amnt / least(person_income, 500000e0), 0.8e0), 0e0), 2) as loan_percent_income,
 loan_status = 1 as is_recent_default,
 0e0 as crisis_exposure
from customers"""

CLEAN_COLS = ["customer_id", "row_ord", "person_age", "person_income", "person_home_ownership",
              "person_emp_length", "loan_intent", "loan_grade", "loan_amnt", "loan_int_rate",
              "loan_status", "cb_person_default_on_file", "cb_person_cred_hist_length",
              "loan_percent_income", "is_recent_default", "crisis_exposure"]


def clean_view(spark, d):
    return CL.clean_customers(FX.customers(spark, d)).select(*CLEAN_COLS)


def sql_clean(body: str, *extra: str) -> str:
    """``body`` over a ``clean`` CTE plus extra fixture views."""
    inner = with_views(f"with clean as ({CLEAN_SQL}\n)\n{body}", "customers", *extra)
    return inner


STG_SQL = """
select customer_id, cast(round(person_age) as int) as person_age, person_income, person_home_ownership,
 person_emp_length, loan_intent, loan_grade, loan_amnt, loan_int_rate, loan_status, loan_percent_income,
 cb_person_default_on_file, cb_person_cred_hist_length, is_recent_default
from clean where person_age > 18 and person_income > 0 and loan_amnt > 0"""


# ------------------------------------------------------------------ A. sources

@query("scan_parquet", sql_clean("select * from clean"))
def scan_parquet(spark, d):
    """A4: write the cleaned table to the shared cache folder, read it back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cache/customers-{uuid.uuid4().hex}"
    clean_view(spark, d).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("load_counts", with_views("""
select 'customers' as table_name, count(*) as submitted, count(*) as kept from customers
union all
select 'relationships', (select count(*) from edges),
 (select count(*) from edges e where e.src_customer_id in (select customer_id from customers)
    and e.dst_customer_id in (select customer_id from customers))""", "customers", "edges"))
def load_counts(spark, d):
    from lendnet.sources.sinks import load_counts as lc
    return lc(FX.customers(spark, d), FX.edges(spark, d))


@query("graph_load", with_views("""
select e.edge_ord, e.src_customer_id, e.dst_customer_id, e.edge_type
from edges e
where e.src_customer_id in (select customer_id from customers)
  and e.dst_customer_id in (select customer_id from customers)""", "customers", "edges"))
def graph_load(spark, d):
    from lendnet.sources.sinks import graph_load as gl
    _, kept = gl(FX.customers(spark, d), FX.edges(spark, d))
    return kept.select("edge_ord", "src_customer_id", "dst_customer_id", "edge_type")


@query("graph_load_nodes", with_views("""
select customer_id, person_age, person_income, loan_amnt, loan_status, cb_person_default_on_file, loan_intent
from customers""", "customers"))
def graph_load_nodes(spark, d):
    from lendnet.sources.sinks import graph_load as gl
    nodes, _ = gl(FX.customers(spark, d), FX.edges(spark, d))
    return nodes


# ------------------------------------------------------------- B. projections

@query("row_ids", """
select event_id, row_number() over (order by ts, event_id) - 1 as row_id,
 concat('EV_', cast(row_number() over (order by ts, event_id) - 1 as varchar)) as row_label
from events""")
def row_ids(spark, d):
    ev = FX.read_table(spark, d, "events").select("event_id", "ts")
    r = with_row_ids(ev, ["ts", "event_id"], name="row_id")
    return r.select("event_id", "row_id", F.concat(F.lit("EV_"), F.col("row_id").cast("string")).alias("row_label"))


@query("edge_ids", """
select o_orderkey, concat('PROSPER_', cast(o_custkey as varchar)) as node_id from orders""")
def edge_ids(spark, d):
    o = FX.read_table(spark, d, "orders")
    return o.select("o_orderkey", F.concat(F.lit("PROSPER_"), F.col("o_custkey").cast("string")).alias("node_id"))


@query("fill_median", with_views("""
select customer_id,
 coalesce(person_emp_length, (select median(person_emp_length) from customers)) as person_emp_length,
 coalesce(loan_int_rate, (select median(loan_int_rate) from customers)) as loan_int_rate
from customers""", "customers"))
def fill_median(spark, d):
    c = FX.customers(spark, d)
    return CL.fill_median(c, ["person_emp_length", "loan_int_rate"]).select(
        "customer_id", "person_emp_length", "loan_int_rate")


@query("clip_outliers", with_views("""
select customer_id, least(person_age, 60) as person_age,
 greatest(least(person_income, 30000e0), 20000e0) as person_income,
 case when person_emp_length is null then null else least(person_emp_length, 20e0) end as person_emp_length
from customers""", "customers"))
def clip_outliers(spark, d):
    c = FX.customers(spark, d)
    return CL.clip_outliers(c, {"person_age": (None, 60), "person_income": (20000.0, 30000.0),
                                "person_emp_length": (None, 20.0)}).select(
        "customer_id", "person_age", "person_income", "person_emp_length")


@query("encode_flag", with_views("""
select customer_id, cast(case when coalesce(cb_person_default_on_file, '') = 'Y' then 1 else 0 end as int) as flag
from customers""", "customers"))
def encode_flag(spark, d):
    c = FX.customers(spark, d)
    return c.select("customer_id", C.encode_flag("cb_person_default_on_file").alias("flag"))


@query("clean_customers", sql_clean("select * from clean"))
def clean_customers(spark, d):
    return clean_view(spark, d)


@query("stg_customers", sql_clean(STG_SQL))
def stg_customers(spark, d):
    return CL.stg_customers(clean_view(spark, d))


@query("stg_relationships", with_views("""
select src_customer_id, dst_customer_id, edge_type,
 case when edge_type in ('co-borrower', 'guarantor', 'employer', 'loan') then edge_type else 'unknown' end
   as validated_edge_type
from edges where src_customer_id != dst_customer_id""", "edges"))
def stg_relationships(spark, d):
    return CL.stg_relationships(FX.edges(spark, d))


@query("rate_band", with_views("""
select customer_id, loan_int_rate,
 case when loan_int_rate > 15 then 'high' when loan_int_rate > 10 then 'medium' else 'low' end as band
from customers""", "customers"))
def rate_band(spark, d):
    C.register_sql_functions(spark)
    FX.customers(spark, d).createOrReplaceTempView("lendnet_customers")
    # the SQL function and the Column function must agree; the query uses the SQL form
    return spark.sql("select customer_id, loan_int_rate, rate_band(loan_int_rate) as band from lendnet_customers")


@query("decision_band", with_views("""
select id, p, case when p < 0.441e0 / 2 then 'low' when p < 0.441e0 then 'medium' else 'high' end as band
from predictions""", "predictions"))
def decision_band(spark, d):
    p = FX.predictions(spark, d)
    return p.select("id", "p", C.decision_band("p", 0.441).alias("band"))


@query("loan_pct_income", sql_clean("""
select customer_id, round(greatest(least(loan_amnt / person_income, 0.8e0), 0e0), 2) as lpi from clean"""))
def loan_pct_income(spark, d):
    c = clean_view(spark, d)
    return c.select("customer_id", CL.loan_pct_income(F.col("loan_amnt"), F.col("person_income")).alias("lpi"))


@query("grade_bucket", sql_clean("""
select customer_id,
 substr('ABCDEFG', cast(greatest(least(floor(loan_percent_income / 0.8e0 * 7), 6), 0) as int) + 1, 1) as grade
from clean"""))
def grade_bucket(spark, d):
    c = clean_view(spark, d)
    return c.select("customer_id", C.grade_from_score(F.col("loan_percent_income") / F.lit(0.8)).alias("grade"))


@query("vulnerability", sql_clean("""
select customer_id,
 round(case when person_income is not null and loan_amnt is not null and person_income > 0 and loan_amnt <> 0
      then 0.5e0 + least(loan_amnt / person_income, 1e0) else 1e0 end, 9) as vulnerability
from clean"""))
def vulnerability(spark, d):
    c = clean_view(spark, d)
    return rnd(c.select("customer_id", C.vulnerability("person_income", "loan_amnt").alias("vulnerability")),
               ["vulnerability"], 9)


@query("edge_stress", with_views("""
select edge_ord, edge_type,
 case edge_type when 'co-borrower' then 1.0e0 when 'guarantor' then 0.7e0 when 'employer' then 0.4e0
   when 'loan' then 1.0e0 else 1.0e0 end as weight
from edges""", "edges"))
def edge_stress(spark, d):
    e = FX.edges(spark, d)
    return e.select("edge_ord", "edge_type", C.edge_stress("edge_type").alias("weight"))
