"""Metrics, ranks, splits, drift and data-quality queries (survey §2.D, §2.E)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendnet.operators import drift as DR
from lendnet.operators import metrics as M
from lendnet.operators import order as O
from lendnet.operators import quality as Q
from lendnet.plans.catalog import query, rnd
from lendnet.session import ensure_checkpoint_dir
from lendnet.sources import fixtures as FX
from lendnet.sources.fixtures import with_views

HIST = "h as (select p as score, sum(y) as pos, sum(1 - y) as neg from predictions group by p)"
CURVE = HIST + """,
c as (select score as threshold, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp
      from h),
curve as (select threshold, tp, fp, coalesce(tp * 1e0 / nullif(tp + fp, 0), 0e0) as precision,
          coalesce(tp * 1e0 / nullif((select sum(pos) from h), 0), 0e0) as recall from c),
f as (select *, 2e0 * precision * recall / (precision + recall + 1e-8) as f1 from curve),
best as (select threshold, f1 from f order by f1 desc, threshold asc limit 1)"""
AUC_ONLY = """
ac as (select score, pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding
       and 1 preceding), 0) as nb from h),
auc as (select sum(pos * (nb + neg / 2e0)) / (sum(pos) * 1e0 * sum(neg)) as roc_auc from ac)"""
AUC = HIST + "," + AUC_ONLY


def preds(spark, d):
    return FX.predictions(spark, d)


@query("roc_auc", with_views(f"with {AUC}\nselect round(roc_auc, 9) as roc_auc from auc", "predictions"))
def roc_auc(spark, d):
    return rnd(M.roc_auc(preds(spark, d)), ["roc_auc"], 9)


@query("pr_curve", with_views(f"""with {CURVE}
select threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp, round(precision, 9) as precision,
 round(recall, 9) as recall from curve""", "predictions"))
def pr_curve(spark, d):
    return rnd(M.pr_curve(preds(spark, d)), ["precision", "recall"], 9)


@query("best_threshold", with_views(f"with {CURVE}\nselect threshold, round(f1, 9) as f1 from best", "predictions"))
def best_threshold(spark, d):
    return rnd(M.best_threshold(preds(spark, d)), ["f1"], 9)


CLF = """
select round((tp + tn) * 1e0 / (tp + fp + fn + tn), 9) as accuracy,
 round(coalesce(tp * 1e0 / nullif(tp + fp, 0), 0e0), 9) as precision,
 round(coalesce(tp * 1e0 / nullif(tp + fn, 0), 0e0), 9) as recall,
 round(coalesce(2e0 * (tp * 1e0 / nullif(tp + fp, 0)) * (tp * 1e0 / nullif(tp + fn, 0))
   / nullif(tp * 1e0 / nullif(tp + fp, 0) + tp * 1e0 / nullif(tp + fn, 0), 0), 0e0), 9) as f1"""


def clf_counts(th: str) -> str:
    return f"""cnt as (select sum(case when p >= {th} and y = 1 then 1 else 0 end) as tp,
 sum(case when p >= {th} and y = 0 then 1 else 0 end) as fp,
 sum(case when p < {th} and y = 1 then 1 else 0 end) as fn,
 sum(case when p < {th} and y = 0 then 1 else 0 end) as tn from predictions)"""


@query("clf_metrics", with_views(f"with {clf_counts('0.5e0')}\n{CLF} from cnt", "predictions"))
def clf_metrics(spark, d):
    return rnd(M.clf_metrics(preds(spark, d), 0.5), ["accuracy", "precision", "recall", "f1"], 9)


@query("evaluate", with_views(f"""with {CURVE}, {AUC_ONLY}, {clf_counts('(select threshold from best)')}
{CLF}, round((select roc_auc from auc), 9) as roc_auc, (select threshold from best) as optimal_threshold
from cnt""", "predictions"))
def evaluate(spark, d):
    return rnd(M.evaluate(preds(spark, d)), ["accuracy", "precision", "recall", "f1", "roc_auc"], 9)


@query("class_weight", with_views("""
select sum(case when y = 0 then 1 else 0 end)::bigint as n_neg, sum(case when y = 1 then 1 else 0 end)::bigint as n_pos,
 case when sum(y) > 0 then sum(case when y = 0 then 1 else 0 end) * 1e0 / sum(y) else 1e0 end as pos_weight
from predictions""", "predictions"))
def class_weight(spark, d):
    return M.class_weight(preds(spark, d))


@query("quality_gate", with_views(f"""with {AUC}
select round(roc_auc, 9) as roc_auc, roc_auc >= 0.72 as passed from auc""", "predictions"))
def quality_gate(spark, d):
    return rnd(M.quality_gate(M.roc_auc(preds(spark, d))), ["roc_auc"], 9)


# ------------------------------------------------------------------ ranks, splits

@query("income_pctile", with_views("""
select customer_id, (row_number() over (order by person_income, customer_id) - 1) * 1e0 / count(*) over ()
  as pctile from customers""", "customers"))
def income_pctile(spark, d):
    c = FX.customers(spark, d).select("customer_id", "person_income")
    return rnd(O.rank_pctile(c, "person_income", "customer_id").select("customer_id", "pctile"), ["pctile"], 9)


@query("quartile_bucket", with_views("""
with e as (select list_distinct(list_sort([quantile_cont(person_income, 0e0), quantile_cont(person_income, 0.25e0),
             quantile_cont(person_income, 0.5e0), quantile_cont(person_income, 0.75e0),
             quantile_cont(person_income, 1e0)])) as edges from customers)
select customer_id, case when person_income is null then 0 else
  greatest(cast(len(list_filter((select edges from e), lambda x: x < person_income)) as int) - 1, 0) end as bucket
from customers""", "customers"))
def quartile_bucket(spark, d):
    from lendnet.operators.features_extra import quartile_bucket as qb
    return qb(FX.customers(spark, d), "person_income").select("customer_id", "bucket")


@query("bucket_sizes", with_views("""
with e as (select list_distinct(list_sort([quantile_cont(person_income, 0e0), quantile_cont(person_income, 0.25e0),
             quantile_cont(person_income, 0.5e0), quantile_cont(person_income, 0.75e0),
             quantile_cont(person_income, 1e0)])) as edges from customers),
b as (select loan_intent, case when person_income is null then 0 else
  greatest(cast(len(list_filter((select edges from e), lambda x: x < person_income)) as int) - 1, 0) end as bucket
  from customers)
select loan_intent, bucket, count(*) as n from b group by 1, 2""", "customers"))
def bucket_sizes(spark, d):
    from lendnet.operators.features_extra import quartile_bucket as qb
    b = qb(FX.customers(spark, d), "person_income")
    return b.groupBy("loan_intent", "bucket").agg(F.count(F.lit(1)).alias("n"))


SPLIT_SQL = """
with h as (select id, y, ('0x' || substr(md5('42|' || cast(id as varchar)), 1, 13))::bigint as hk from predictions),
r as (select id, y, row_number() over (partition by y order by hk, id) - 1 as rk, count(*) over (partition by y) as nc
      from h)"""


@query("stratified_split", with_views(SPLIT_SQL + """
select id, y, case when rk < round(nc * 0.8) then 'train' else 'test' end as split from r""", "predictions"))
def stratified_split(spark, d):
    return O.stratified_split(preds(spark, d).select("id", "y"), "y", "id", 42).select("id", "y", "split")


@query("split3", with_views(SPLIT_SQL + """
select id, y, case when rk < round(nc * 0.6) then 'train' when rk < round(nc * 0.8) then 'val' else 'test' end
  as split from r""", "predictions"))
def split3(spark, d):
    return O.stratified_split(preds(spark, d).select("id", "y"), "y", "id", 42, (0.6, 0.2, 0.2),
                              ("train", "val", "test")).select("id", "y", "split")


DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_BASE = """
base as (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
   row_number() over (order by l_orderkey, l_linenumber) - 1 as rn, count(*) over () as n from lineitem),
lab as (select *, case when rn < floor(n * 0.8) then 'reference' else 'current' end as part from base)"""
KS_SQL = DRIFT_BASE + """,
lng as (select part, 'l_quantity' as col, l_quantity as v from lab union all
        select part, 'l_extendedprice', l_extendedprice from lab union all
        select part, 'l_discount', l_discount from lab union all
        select part, 'l_tax', l_tax from lab),
h as (select col, v, sum(case when part = 'reference' then 1 else 0 end) as nr,
        sum(case when part = 'reference' then 0 else 1 end) as nc from lng where v is not null group by 1, 2),
cdf as (select col, v, sum(nr) over (partition by col order by v) * 1e0 / sum(nr) over (partition by col) as fr,
          sum(nc) over (partition by col order by v) * 1e0 / sum(nc) over (partition by col) as fc,
          sum(nr) over (partition by col) as n_ref, sum(nc) over (partition by col) as n_cur from h),
ks as (select col as "column", max(abs(fr - fc)) as ks_d, max(n_ref)::bigint as n_ref, max(n_cur)::bigint as n_cur
       from cdf group by col)"""


def drift_input(spark, d):
    li = FX.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *DRIFT_COLS)
    return O.positional_split(li, ["l_orderkey", "l_linenumber"], 0.8)


@query("drift_split", with_views(DRIFT_BASE + """
select l_orderkey, l_linenumber, part from lab"""))
def drift_split(spark, d):
    return drift_input(spark, d).select("l_orderkey", "l_linenumber", "part")


@query("drift_ks", "with " + KS_SQL + """
select "column", round(ks_d, 9) as ks_d, n_ref, n_cur from ks""")
def drift_ks(spark, d):
    ks = DR.ks_by_column(drift_input(spark, d), DRIFT_COLS)
    return rnd(ks.select("column", "ks_d", "n_ref", "n_cur"), ["ks_d"], 9)


PVAL_SQL = KS_SQL + """,
lam as (select "column", ks_d, sqrt(n_ref * n_cur * 1e0 / (n_ref + n_cur)) * ks_d as lam from ks),
pv as (select "column", ks_d, case when lam < 0.05 then 1e0 else
          least(greatest(2e0 * (select sum(case when k % 2 = 1 then 1e0 else -1e0 end * exp(-2e0 * k * k * lam * lam))
                                 from range(1, 101) t(k)), 0e0), 1e0) end as p_value from lam)"""


@query("drift_pvalues", "with " + PVAL_SQL + """
select "column", round(ks_d, 9) as ks_d, round(p_value, 9) as p_value, p_value < 0.05 as drifted from pv""")
def drift_pvalues(spark, d):
    ks = DR.ks_by_column(drift_input(spark, d), DRIFT_COLS)
    out = ks.select("column", "ks_d", "p_value", (F.col("p_value") < 0.05).alias("drifted"))
    return rnd(out, ["ks_d", "p_value"], 9)


@query("drift_summary", "with " + PVAL_SQL + """
select sum(case when p_value < 0.05 then 1 else 0 end)::bigint as n_drifted_columns,
 round(sum(case when p_value < 0.05 then 1 else 0 end) * 1e0 / count(*), 9) as drift_share,
 sum(case when p_value < 0.05 then 1 else 0 end) > 0 as drift_detected from pv""")
def drift_summary(spark, d):
    ks = DR.ks_by_column(drift_input(spark, d), DRIFT_COLS)
    # the per-column map stays in the library result; the checked columns are the scalars
    return rnd(DR.drift_summary(ks).drop("drift_by_column"), ["drift_share"], 9).withColumn(
        "n_drifted_columns", F.col("n_drifted_columns").cast("bigint"))


@query("drift_stored", "with " + PVAL_SQL + """
select "column", round(pv.ks_d, 9) as ks_d, n_ref, n_cur, round(p_value, 9) as p_value
from pv join ks using ("column")""")
def drift_stored(spark, d):
    """The reference as a stored histogram, merged from two parts; the current rows as one batch against it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift-reference-{uuid.uuid4().hex}"
    rows = drift_input(spark, d)
    part = rows.filter(F.col("part") == "reference")
    DR.store_reference(DR.value_histogram(part.filter("l_linenumber <= 3"), DRIFT_COLS), spark, path, 0)
    DR.merge_reference(DR.value_histogram(part.filter("l_linenumber > 3"), DRIFT_COLS), spark, path, 1)
    batch = DR.value_histogram(rows.filter(F.col("part") == "current"), DRIFT_COLS)
    return rnd(DR.ks_against_reference(DR.read_reference(spark, path), batch), ["ks_d", "p_value"], 9)


# ---------------------------------------------------------------- data quality

RULES = [
    Q.Rule("customers", "customer_id", "unique"), Q.Rule("customers", "customer_id", "not_null"),
    Q.Rule("customers", "person_emp_length", "not_null"), Q.Rule("customers", "loan_int_rate", "not_null"),
    Q.Rule("customers", "loan_status", "accepted_values", (0, 1)),
    Q.Rule("edges", "edge_type", "accepted_values", ("co-borrower", "guarantor", "employer", "loan")),
    Q.Rule("edges", "src_customer_id", "not_null"),
    Q.Rule("scoring_events", "scoring_event_id", "unique"),
    Q.Rule("scoring_events", "decision_band", "accepted_values", ("low", "medium", "high")),
    Q.Rule("scoring_events", "risk_score", "not_null"),
]


@query("dq_unique", with_views("""
select customer_id as value, count(*) as n from (select customer_id from customers union all
  select src_customer_id from edges) where customer_id is not null group by 1 having count(*) > 1""",
                               "customers", "edges"))
def dq_unique(spark, d):
    both = FX.customers(spark, d).select("customer_id").unionAll(
        FX.edges(spark, d).select(F.col("src_customer_id").alias("customer_id")))
    return Q.dq_unique(both, "customer_id")


@query("dq_not_null", with_views("""
select customer_id, person_emp_length from customers where person_emp_length is null""", "customers"))
def dq_not_null(spark, d):
    return Q.dq_not_null(FX.customers(spark, d), "person_emp_length").select("customer_id", "person_emp_length")


@query("dq_accepted", with_views("""
select edge_ord, edge_type from edges where edge_type is not null
 and edge_type not in ('co-borrower', 'guarantor', 'employer', 'loan')""", "edges"))
def dq_accepted(spark, d):
    return Q.dq_accepted(FX.edges(spark, d), "edge_type", list(RULES[5].values)).select("edge_ord", "edge_type")


def _rule_sql(r: Q.Rule) -> str:
    if r.test == "not_null":
        e = f"(select count(*) from {r.table} where {r.column} is null)"
    elif r.test == "accepted_values":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r.values)
        e = f"(select count(*) from {r.table} where {r.column} is not null and {r.column} not in ({vals}))"
    else:
        e = (f"(select count(*) from (select {r.column} from {r.table} where {r.column} is not null "
             f"group by 1 having count(*) > 1))")
    return f"select '{r.table}' as table_name, '{r.column}' as column_name, '{r.test}' as test, {e}::bigint as failures"


@query("dq_report", with_views("\nunion all\n".join(_rule_sql(r) for r in RULES),
                               "customers", "edges", "scoring_events"))
def dq_report(spark, d):
    tables = {"customers": FX.customers(spark, d), "edges": FX.edges(spark, d),
              "scoring_events": FX.scoring_events(spark, d)}
    return Q.dq_report(tables, RULES)


PROPERTIES = [
    Q.Rule("customers", "customer_id", "unique"), Q.Rule("customers", "customer_id", "starts_with", ("CUST_",)),
    Q.Rule("customers", "person_age", "bounds", (18, 75)), Q.Rule("customers", "person_income", "bounds", (0.0, None)),
    Q.Rule("customers", "loan_int_rate", "bounds", (3.0, 27.0)),
    Q.Rule("customers", "loan_amnt", "equals", ("loan_amnt <= person_income * 2",), "at most two incomes"),
    Q.Rule("edges", "src_customer_id", "subset", ("customers", "customer_id")),
    Q.Rule("edges", "dst_customer_id", "subset", ("lenders", "customer_id")),
    Q.Rule("edges", "src_customer_id", "differs", ("dst_customer_id",), "no self-loops"),
    Q.Rule("edges", "edge_ord", "ratio", ("customers", 0.5, 5.0), "edges per customer"),
    Q.Rule("edges", "edge_ord", "ratio", ("customers", 0.5, 2.0), "few edges per customer"),
    Q.Rule("shares", "share", "sums_to", (1.0, 1e-9)), Q.Rule("shares", "share", "sums_to", (0.5, 1e-9), "half"),
    Q.Rule("predictions", "p", "bounds", (0.0, 1.0)), Q.Rule("predictions", "y", "accepted_values", (0, 1)),
]


def _property_sql(r: Q.Rule) -> str:
    c, t = r.column, r.table
    if r.test == "subset":
        e = f"select count(*) from {t} where {c} is not null and {c} not in (select {r.values[1]} from {r.values[0]})"
    elif r.test == "unique":
        e = f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"
    elif r.test == "sums_to":
        e = f"select case when abs(coalesce(sum({c}), 0) - {r.values[0]}) > {r.values[1]} then 1 else 0 end from {t}"
    elif r.test == "ratio":
        e = (f"select case when count(*) * 1e0 / nullif((select count(*) from {r.values[0]}), 0) "
             f"between {r.values[1]} and {r.values[2]} then 0 else 1 end from {t}")
    else:
        bad = {"starts_with": lambda: f"not starts_with({c}, '{r.values[0]}')", "differs": lambda: f"{c} = {r.values[0]}",
               "equals": lambda: f"not ({r.values[0]})",
               "accepted_values": lambda: f"{c} not in ({', '.join(map(str, r.values))})",
               "bounds": lambda: " or ".join(x for x in (
                   "" if r.values[0] is None else f"{c} < {r.values[0]}",
                   "" if r.values[1] is None else f"{c} > {r.values[1]}") if x)}[r.test]()
        e = f"select count(*) from {t} where {bad}"
    return (f"select '{t}' as table_name, '{c}' as column_name, '{r.test}' as test, '{r.name}' as name, "
            f"({e})::bigint as failures")


@query("dq_properties", with_views("""with lenders as (select customer_id from customers where loan_grade < 'F'),
shares as (select count(*) * 1e0 / (select count(*) from predictions) as share from predictions group by y)
""" + "\nunion all\n".join(_property_sql(r) for r in PROPERTIES), "customers", "edges", "predictions"))
def dq_properties(spark, d):
    customers, pred = FX.customers(spark, d), FX.predictions(spark, d)
    total = pred.agg(F.count(F.lit(1)).cast("double")).scalar()
    tables = {"customers": customers, "edges": FX.edges(spark, d), "predictions": pred,
              "lenders": customers.filter("loan_grade < 'F'").select("customer_id"),
              "shares": pred.groupBy("y").agg((F.count(F.lit(1)) / total).alias("share"))}
    return Q.dq_properties(tables, PROPERTIES)
