"""Credit-network views over the driver's TPC-H-like tables.

Each view exists twice: as a Spark DataFrame builder (what the operators consume)
and as a SQL text (what the DuckDB oracle consumes as a CTE). Both follow the same
definition; neither caps or samples rows, so every view grows with its tables.

Edges are derived with a 1:1 key join (an urgent order links its customer to the
customer of the next order, a high-priority order to the customer three orders
on), so the edge count is linear in ``orders`` and no group emits all its pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendnet.schemas import GRADES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------- Spark side

def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    o = (read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        (F.max("o_totalprice") / F.lit(10.0)).alias("amt"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("nf")))
    grades = F.array(*[F.lit(g) for g in GRADES])
    j = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey)
          .join(o, o.o_custkey == c.c_custkey, "left"))
    key = F.col("c_custkey")
    return j.select(
        F.concat(F.lit("CUST_"), key.cast("string")).alias("customer_id"),
        key.alias("row_ord"),
        (F.lit(17) + key % 63).cast("int").alias("person_age"),
        (F.lit(15000.0) + (F.col("c_acctbal") + F.lit(1000.0)) * F.lit(20.0)).alias("person_income"),
        F.col("c_mktsegment").alias("person_home_ownership"),
        F.when(key % 13 == 0, F.lit(None).cast("double")).otherwise((key % 41).cast("double"))
         .alias("person_emp_length"),
        F.col("r_name").alias("loan_intent"),
        F.element_at(grades, (key % 7).cast("int") + 1).alias("loan_grade"),
        F.coalesce(F.col("amt"), F.lit(0.0)).alias("loan_amnt"),
        F.when(key % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(3.0) + F.col("c_nationkey").cast("double")).alias("loan_int_rate"),
        F.when(F.coalesce(F.col("nf"), F.lit(0)) * 5 > F.coalesce(F.col("n"), F.lit(0)) * 2, 1)
         .otherwise(0).cast("int").alias("loan_status"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("cb_person_default_on_file"),
        (F.lit(1) + key % 30).cast("int").alias("cb_person_cred_hist_length"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    a = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("a")
    b = o.select(F.col("o_orderkey").alias("b_key"), F.col("o_custkey").alias("b_cust"))
    step = F.when(F.col("a.o_orderpriority") == "1-URGENT", 1).otherwise(3)
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    ca = cu.select(F.col("c_custkey").alias("ca_key"), F.col("c_mktsegment").alias("ca_seg"),
                   F.col("c_nationkey").alias("ca_nat"))
    cb = cu.select(F.col("c_custkey").alias("cb_key"), F.col("c_mktsegment").alias("cb_seg"),
                   F.col("c_nationkey").alias("cb_nat"))
    j = (a.join(b, F.col("b_key") == F.col("a.o_orderkey") + step)
          .join(ca, F.col("ca_key") == F.col("a.o_custkey"))
          .join(cb, F.col("cb_key") == F.col("b_cust")))
    etype = (F.when((F.col("a.o_orderkey") + F.col("b_key")) % 5 == 0, "other")
              .when(F.col("ca_seg") == F.col("cb_seg"), "co-borrower")
              .when(F.col("ca_nat") % 5 == F.col("cb_nat") % 5, "employer")
              .otherwise("guarantor"))
    return j.select(
        F.col("a.o_orderkey").alias("edge_ord"),
        F.concat(F.lit("CUST_"), F.col("a.o_custkey").cast("string")).alias("src_customer_id"),
        F.concat(F.lit("CUST_"), F.col("b_cust").cast("string")).alias("dst_customer_id"),
        etype.alias("edge_type"),
        F.col("a.o_orderdate").alias("ts"),
    )


def _band(score):
    return F.when(score < 0.2205, "low").when(score < 0.441, "medium").otherwise("high")


def scoring_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    score = F.least(F.col("value") / F.lit(100.0), F.lit(1.0))
    return e.select(
        F.col("event_id").cast("string").alias("scoring_event_id"),
        F.concat(F.lit("CUST_"), F.col("user_id").cast("string")).alias("customer_id"),
        score.alias("risk_score"),
        (F.col("value") * F.lit(100.0)).alias("requested_amount"),
        F.col("ts").alias("scored_at"),
        _band(score).alias("decision_band"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts",
        F.concat(F.lit("/"), F.col("event_type")).alias("handler"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / F.lit(1000.0)).alias("duration_s"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("y"),
        F.round(F.col("o_totalprice") / F.lit(500000.0), 3).alias("p"),
    )


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = customers(spark, sf_dir)
    j = o.join(c, c.row_ord == o.o_custkey)
    return j.select(
        F.col("o_orderkey").alias("application_id"), "customer_id", "person_age", "person_income",
        "person_home_ownership", "person_emp_length", "loan_intent",
        F.when(F.col("o_orderkey") % 97 == 0, "Z").otherwise(F.col("loan_grade")).alias("loan_grade"),
        F.when(F.col("o_orderkey") % 89 == 0, F.lit(-1.0))
         .otherwise(F.col("o_totalprice") / F.lit(10.0)).alias("loan_amnt"),
        "loan_int_rate",
        F.when(F.col("o_orderkey") % 83 == 0, F.lit(-0.1))
         .otherwise(F.col("o_totalprice") / F.lit(10.0) / F.col("person_income")).alias("loan_percent_income"),
        F.when(F.col("o_orderkey") % 79 == 0, F.lit(None).cast("int"))
         .otherwise(F.col("cb_person_cred_hist_length")).alias("cb_person_cred_hist_length"),
        F.when(F.col("cb_person_default_on_file") == "Y", 1).otherwise(0).cast("int")
         .alias("cb_person_default_on_file"),
        F.col("o_orderdate").alias("applied_at"),
    )


# ----------------------------------------------------------------------- SQL side

VIEW_SQL: dict[str, str] = {
    "customers": """
select concat('CUST_', cast(c.c_custkey as varchar)) as customer_id, c.c_custkey as row_ord,
 cast(17 + c.c_custkey % 63 as int) as person_age,
 15000e0 + (c.c_acctbal + 1000e0) * 20e0 as person_income,
 c.c_mktsegment as person_home_ownership,
 case when c.c_custkey % 13 = 0 then null else cast(c.c_custkey % 41 as double) end as person_emp_length,
 r.r_name as loan_intent,
 substr('ABCDEFG', cast(c.c_custkey % 7 as int) + 1, 1) as loan_grade,
 coalesce(o.amt, 0e0) as loan_amnt,
 case when c.c_custkey % 17 = 0 then null else 3e0 + cast(c.c_nationkey as double) end as loan_int_rate,
 cast(case when coalesce(o.nf, 0) * 5 > coalesce(o.n, 0) * 2 then 1 else 0 end as int) as loan_status,
 case when c.c_acctbal < 0 then 'Y' else 'N' end as cb_person_default_on_file,
 cast(1 + c.c_custkey % 30 as int) as cb_person_cred_hist_length
from customer c join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
left join (select o_custkey, max(o_totalprice) / 10e0 as amt, count(*) as n,
                  sum(case when o_orderstatus = 'F' then 1 else 0 end) as nf
           from orders group by o_custkey) o on o.o_custkey = c.c_custkey""",
    "edges": """
select a.o_orderkey as edge_ord,
 concat('CUST_', cast(a.o_custkey as varchar)) as src_customer_id,
 concat('CUST_', cast(b.o_custkey as varchar)) as dst_customer_id,
 case when (a.o_orderkey + b.o_orderkey) % 5 = 0 then 'other'
      when ca.c_mktsegment = cb.c_mktsegment then 'co-borrower'
      when ca.c_nationkey % 5 = cb.c_nationkey % 5 then 'employer' else 'guarantor' end as edge_type,
 a.o_orderdate as ts
from orders a
join orders b on b.o_orderkey = a.o_orderkey + case when a.o_orderpriority = '1-URGENT' then 1 else 3 end
join customer ca on ca.c_custkey = a.o_custkey
join customer cb on cb.c_custkey = b.o_custkey
where a.o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "scoring_events": """
select cast(event_id as varchar) as scoring_event_id,
 concat('CUST_', cast(user_id as varchar)) as customer_id,
 least(value / 100e0, 1e0) as risk_score, value * 100e0 as requested_amount, ts as scored_at,
 case when least(value / 100e0, 1e0) < 0.2205e0 then 'low'
      when least(value / 100e0, 1e0) < 0.441e0 then 'medium' else 'high' end as decision_band
from events""",
    "requests": """
select event_id, ts, concat('/', event_type) as handler,
 case when event_type = 'error' then 500 else 200 end as status, value / 1000e0 as duration_s
from events""",
    "predictions": """
select o_orderkey as id, cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as y,
 round(o_totalprice / 500000e0, 3) as p
from orders""",
    "applications": """
select o.o_orderkey as application_id, c.customer_id, c.person_age, c.person_income,
 c.person_home_ownership, c.person_emp_length, c.loan_intent,
 case when o.o_orderkey % 97 = 0 then 'Z' else c.loan_grade end as loan_grade,
 case when o.o_orderkey % 89 = 0 then -1e0 else o.o_totalprice / 10e0 end as loan_amnt,
 c.loan_int_rate,
 case when o.o_orderkey % 83 = 0 then -0.1e0 else o.o_totalprice / 10e0 / c.person_income end as loan_percent_income,
 case when o.o_orderkey % 79 = 0 then null else c.cb_person_cred_hist_length end as cb_person_cred_hist_length,
 cast(case when c.cb_person_default_on_file = 'Y' then 1 else 0 end as int) as cb_person_default_on_file,
 o.o_orderdate as applied_at
from orders o join customers c on c.row_ord = o.o_custkey""",
}

# Views that other views reference (must come first in a WITH list).
_VIEW_DEPS = {"applications": ["customers"]}

VIEWS = {
    "customers": customers, "edges": edges, "scoring_events": scoring_events,
    "requests": requests, "predictions": predictions, "applications": applications,
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named fixture views as CTEs (dependencies first)."""
    ordered: list[str] = []
    for n in names:
        for dep in _VIEW_DEPS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]}\n)" for n in ordered)
    body = body.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
