"""Feature mart, model-input and scoring queries (survey §2.B B13-B29, §2.C, §2.I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendnet.operators import clean as CL
from lendnet.operators import features as FE
from lendnet.operators import model as MD
from lendnet.plans.catalog import query, rnd
from lendnet.plans.q_clean import CLEAN_SQL, STG_SQL, clean_view
from lendnet.operators.trees import TreeNode, tree_contrib
from lendnet.plans.q_graph import GF_CTE, GF_ROUND, graph_features_view, round_gf
from lendnet.schemas import CAT_COLS, FEATURES, GRAPH_FEATURES
from lendnet.sources import fixtures as FX
from lendnet.session import cut_lineage
from lendnet.sources.fixtures import with_views

GF_BODY = f"with recursive clean as ({CLEAN_SQL}\n), {GF_CTE}"


def gf_sql(body: str, *views: str) -> str:
    return with_views(f"{GF_BODY}\n{body}", "customers", "edges", *views)


MART_COLS = ", ".join(["c.customer_id", "c.person_age", "c.person_income", "c.person_home_ownership",
                       "c.person_emp_length", "c.loan_intent", "c.loan_grade", "c.loan_amnt", "c.loan_int_rate",
                       "c.loan_status", "c.loan_percent_income", "c.cb_person_default_on_file",
                       "c.cb_person_cred_hist_length", "c.is_recent_default"])


@query("stg_graph_features", gf_sql(f"{GF_ROUND} from gf"))
def stg_graph_features(spark, d):
    return round_gf(CL.stg_graph_features(graph_features_view(spark, d)))


@query("fct_credit_features", gf_sql(f""",
stg as ({STG_SQL}),
g as ({GF_ROUND} from gf)
select {MART_COLS},
 case when c.loan_int_rate > 15.0 then 'high' when c.loan_int_rate > 10.0 then 'medium' else 'low' end
   as interest_rate_risk_band,
 g.degree, g.in_degree, g.out_degree, g.norm_in_degree, g.norm_out_degree, g.pagerank,
 g.distance_to_prior_default, g.clustering_coefficient, g.neighbor_default_frac, g.neighbor_default_frac_2hop
from stg c left join g on g.customer_id = c.customer_id"""))
def fct_credit_features(spark, d):
    stg = CL.stg_customers(clean_view(spark, d))
    g = round_gf(CL.stg_graph_features(graph_features_view(spark, d)))
    return FE.fct_credit_features(stg, g)


# ------------------------------------------------------------ model input

CLASSES_SQL = """,
j as (select c.*, g.* exclude (customer_id) from clean c left join gf g on g.customer_id = c.customer_id),
cls as (""" + " union all ".join(
    f"select '{c}' as col, v, (row_number() over (order by v) - 1)::int as code from "
    f"(select distinct cast({c} as varchar) as v from j)" for c in CAT_COLS) + ")"

ENC_SQL = CLASSES_SQL + """,
enc as (select j.* replace (h.code as person_home_ownership, i.code as loan_intent, gr.code as loan_grade)
        from j left join cls h on h.col = 'person_home_ownership' and h.v = j.person_home_ownership
        left join cls i on i.col = 'loan_intent' and i.v = j.loan_intent
        left join cls gr on gr.col = 'loan_grade' and gr.v = j.loan_grade),
feat as (select *, loan_amnt / person_income as dti from enc),
feat2 as (select *, norm_in_degree * dti as norm_in_x_dti, norm_in_degree * neighbor_default_frac as norm_in_x_nbr_def,
          dti * cb_person_default_on_file as dti_x_cb_default, loan_int_rate * dti as int_rate_x_dti,
          in_degree / (out_degree + 1e0) as degree_ratio, ln(1 + person_income) as income_log from feat)"""

ROUND9 = ["norm_in_degree", "norm_out_degree", "pagerank", "clustering_coefficient", "neighbor_default_frac",
          "neighbor_default_frac_2hop", "dti", "norm_in_x_dti", "norm_in_x_nbr_def", "dti_x_cb_default",
          "int_rate_x_dti", "degree_ratio", "income_log"]


def _assembled(spark, d):
    return MD.assemble_features(clean_view(spark, d), graph_features_view(spark, d))


@query("label_encode", gf_sql(CLASSES_SQL + "\nselect col as \"column\", v as class, code from cls"))
def label_encode(spark, d):
    return _classes(spark, d)


@query("assemble_features", gf_sql(ENC_SQL + "\nselect customer_id, " + ", ".join(
    f"round({c}, 9) as {c}" if c in ROUND9 else c for c in FEATURES) + ", loan_status as label from feat2"))
def assemble_features(spark, d):
    a, _ = _assembled(spark, d)
    return rnd(a, ROUND9, 9)


@query("derived_features", gf_sql(ENC_SQL + "\nselect customer_id, " + ", ".join(
    f"round({c}, 9) as {c}" for c in ["dti", "norm_in_x_dti", "norm_in_x_nbr_def", "dti_x_cb_default",
                                        "int_rate_x_dti", "degree_ratio", "income_log"]) + " from feat2"))
def derived_features(spark, d):
    a, _ = _assembled(spark, d)
    cols = ["dti", "norm_in_x_dti", "norm_in_x_nbr_def", "dti_x_cb_default", "int_rate_x_dti", "degree_ratio",
            "income_log"]
    return rnd(a.select("customer_id", *cols), cols, 9)


@query("standardize", gf_sql(ENC_SQL + "\nselect customer_id, " + ", ".join(
    f"round(({c} - (select avg({c}) from feat2)) / ((select stddev_pop({c}) from feat2) + 1e-8), 9) as {c}"
    for c in ["person_income", "loan_amnt", "degree", "pagerank"]) + " from feat2"))
def standardize(spark, d):
    a, _ = _assembled(spark, d)
    cols = ["person_income", "loan_amnt", "degree", "pagerank"]
    return rnd(FE.standardize(a.select("customer_id", *cols), cols), cols, 9)


CONTAGION_SQL = """
select customer_id,
 round(-3e0 + 3e0 * norm_in_degree - 1.5e0 * norm_out_degree + 2.5e0 * (loan_amnt / person_income)
   + 1.2e0 * cb_person_default_on_file - 0.6e0 * (cb_person_cred_hist_length / 30e0) + 0.8e0 * crisis_exposure
   + 2e0 * neighbor_default_frac + 1.5e0 * neighbor_default_frac_2hop
   + 2e0 * norm_in_degree * (loan_amnt / person_income), 9) as logit,
 round(1e0 / (1e0 + exp(-(-3e0 + 3e0 * norm_in_degree - 1.5e0 * norm_out_degree
   + 2.5e0 * (loan_amnt / person_income) + 1.2e0 * cb_person_default_on_file
   - 0.6e0 * (cb_person_cred_hist_length / 30e0) + 0.8e0 * crisis_exposure + 2e0 * neighbor_default_frac
   + 1.5e0 * neighbor_default_frac_2hop + 2e0 * norm_in_degree * (loan_amnt / person_income)))), 9) as default_prob
from j"""


@query("contagion_logit", gf_sql(CLASSES_SQL + CONTAGION_SQL))
def contagion_logit(spark, d):
    j = clean_view(spark, d).join(graph_features_view(spark, d), "customer_id", "left")
    return rnd(FE.contagion_logit(j).select("customer_id", "logit", "default_prob"), ["logit", "default_prob"], 9)


@query("prior_default_prob", gf_sql(""",
nr as (select customer_id, norm_in_degree, greatest(least((out_degree - in_degree) / (degree + 1e0), 1e0), -1e0)
         as net_ratio, 1e0 as crisis_exposure from gf)
select customer_id, round(greatest(least(0.1e0 + 0.15e0 * norm_in_degree - 0.1e0 * net_ratio
  + 0.1e0 * crisis_exposure, 0.5e0), 0.02e0), 9) as prior_default_prob from nr"""))
def prior_default_prob(spark, d):
    from lendnet.operators.graph.edges import net_ratio
    g = net_ratio(graph_features_view(spark, d)).withColumn("crisis_exposure", F.lit(1.0))
    return rnd(FE.prior_default_prob(g).select("customer_id", "prior_default_prob"), ["prior_default_prob"], 9)


# A small fixed forest: (tree, node, feature, threshold, left, right, value, weight); feature -1 = leaf.
SMALL_FEATURES = ["person_age", "person_income", "loan_amnt", "loan_int_rate"]
SMALL_FOREST = [TreeNode(*x) for x in (
    (0, 0, 1, 60000.0, 1, 2, 0.1, 1.0), (0, 1, 2, 15000.0, 3, 4, 0.4, 1.0), (0, 2, -1, 0.0, -1, -1, -0.3, 1.0),
    (0, 3, -1, 0.0, -1, -1, 0.2, 1.0), (0, 4, -1, 0.0, -1, -1, 0.9, 1.0),
    (1, 0, 3, 14.0, 1, 2, 0.05, 0.1), (1, 1, -1, 0.0, -1, -1, -0.2, 0.1), (1, 2, 0, 30.0, 3, 4, 0.5, 0.1),
    (1, 3, -1, 0.0, -1, -1, 0.8, 0.1), (1, 4, -1, 0.0, -1, -1, 0.3, 0.1))]


@query("tree_contrib", with_views("""
select customer_id, round(m0 + m1, 9) as margin, round(c_age, 9) as person_age, round(c_income, 9) as person_income,
 round(c_amnt, 9) as loan_amnt, round(c_rate, 9) as loan_int_rate
from (select customer_id,
 case when person_income <= 60000 then case when loan_amnt <= 15000 then 0.2e0 else 0.9e0 end else -0.3e0 end as m0,
 0.1e0 * case when r <= 14 then -0.2e0 when person_age <= 30 then 0.8e0 else 0.3e0 end as m1,
 case when person_income <= 60000 then 0.3e0 else -0.4e0 end as c_income,
 case when person_income <= 60000 then case when loan_amnt <= 15000 then -0.2e0 else 0.5e0 end else 0e0 end as c_amnt,
 0.1e0 * case when r <= 14 then -0.25e0 else 0.45e0 end as c_rate,
 0.1e0 * case when r <= 14 then 0e0 when person_age <= 30 then 0.3e0 else -0.2e0 end as c_age
 from (select *, coalesce(loan_int_rate, 1e9) as r from customers))""", "customers"))
def tree_contrib_small(spark, d):
    t = tree_contrib(FX.customers(spark, d).select("customer_id", *SMALL_FEATURES), SMALL_FOREST, SMALL_FEATURES)
    cols = [F.col("factors")[i]["shap_value"].alias(c) for i, c in enumerate(SMALL_FEATURES)]
    return rnd(t.select("customer_id", "margin", *cols), ["margin", *SMALL_FEATURES], 9)


# ---------------------------------------------------------------- scoring

SC_TERMS = " + ".join(f"{c}e0 * {f}" if c >= 0 else f"{c}e0 * {f}" for f, c in MD.SCORECARD.items())
SC_FEATS = list(MD.SCORECARD)

SCORE_SQL = ENC_SQL.replace("feat as (select *, loan_amnt / person_income as dti from enc),", "feat as (select 1),") \
    + """,
val as (select a.*, h.code as home_c, i.code as intent_c, gr.code as grade_c from applications a
  left join cls h on h.col = 'person_home_ownership' and h.v = a.person_home_ownership
  left join cls i on i.col = 'loan_intent' and i.v = a.loan_intent
  left join cls gr on gr.col = 'loan_grade' and gr.v = a.loan_grade),
acc as (select * from val where customer_id is not null and person_age between 18 and 100 and person_income > 0
  and person_home_ownership is not null and person_emp_length >= 0 and loan_intent is not null
  and loan_grade is not null and loan_amnt > 0 and loan_int_rate >= 0 and cb_person_default_on_file in (0, 1)
  and loan_percent_income >= 0 and cb_person_cred_hist_length >= 0
  and home_c is not null and intent_c is not null and grade_c is not null),
lk as (select acc.application_id, acc.customer_id, acc.person_age, acc.person_income, acc.loan_amnt,
  acc.loan_int_rate, acc.cb_person_default_on_file, acc.applied_at,
  coalesce(g.norm_in_degree, 0e0) as norm_in_degree, coalesce(g.norm_out_degree, 0e0) as norm_out_degree,
  coalesce(g.neighbor_default_frac, 0e0) as neighbor_default_frac,
  coalesce(g.neighbor_default_frac_2hop, 0e0) as neighbor_default_frac_2hop
  from acc left join gf g on g.customer_id = acc.customer_id),
sc as (select *, loan_amnt / person_income as dti, norm_in_degree * (loan_amnt / person_income) as norm_in_x_dti
       from lk),
scored as (select *, 1e0 / (1e0 + exp(-(-3.0e0 + """ + SC_TERMS + """))) as risk_score from sc),
contrib as (""" + " union all ".join(
    f"select application_id, '{f}' as feature, {c}e0 * ({f} - (select avg({f}) from scored)) as shap_value "
    f"from scored" for f, c in MD.SCORECARD.items()) + """),
ranked as (select *, row_number() over (partition by application_id order by abs(shap_value) desc, feature) as rk
           from contrib),
top as (select application_id, string_agg(feature, ',' order by rk) as top_features from ranked where rk <= 5
        group by application_id)"""


def _classes(spark, d):
    """Fitted category classes: they come from the cleaned customers alone (the left join
    to graph features adds no categorical values)."""
    return CL.label_classes(clean_view(spark, d), CAT_COLS)


def _score(spark, d):
    return MD.score_applications(FX.applications(spark, d), _classes(spark, d), graph_features_view(spark, d), 0.441)


@query("score_events", gf_sql(SCORE_SQL + """
select cast(s.application_id as varchar) as scoring_event_id, s.customer_id, round(s.risk_score, 9) as risk_score,
 case when s.risk_score < 0.2205e0 then 'low' when s.risk_score < 0.441e0 then 'medium' else 'high' end
   as decision_band, s.loan_amnt as requested_amount, t.top_features, s.applied_at as scored_at
from scored s join top t on t.application_id = s.application_id""", "applications"))
def score_events(spark, d):
    ev, _ = _score(spark, d)
    out = ev.withColumn("top_features", F.array_join(F.transform("_factors", lambda x: x["feature"]), ","))
    return rnd(out.select("scoring_event_id", "customer_id", "risk_score", "decision_band", "requested_amount",
                          "top_features", "scored_at"), ["risk_score"], 9)


@query("factors_json", gf_sql(SCORE_SQL + """
select cast(application_id as varchar) as scoring_event_id, rk::int as rank, feature, round(shap_value, 9) as shap_value
from ranked where rk <= 5""", "applications"))
def factors_json(spark, d):
    ev, _ = _score(spark, d)
    back = ev.select("scoring_event_id", F.posexplode(MD.factors_from_json("top_factors")).alias("pos", "f"))
    return rnd(back.select("scoring_event_id", (F.col("pos") + 1).alias("rank"), "f.feature", "f.shap_value"),
               ["shap_value"], 9)


@query("top_factors", gf_sql(SCORE_SQL + """
select application_id, rk::int as rank, feature from ranked where rk <= 5""", "applications"))
def top_factors(spark, d):
    ev, _ = _score(spark, d)
    return ev.select(F.col("scoring_event_id").cast("long").alias("application_id"),
                     F.posexplode("_factors").alias("pos", "f")).select(
        "application_id", (F.col("pos") + 1).cast("int").alias("rank"), "f.feature")


@query("linear_contrib", gf_sql(SCORE_SQL + """
select cast(application_id as varchar) as scoring_event_id, feature, round(shap_value, 9) as shap_value
from contrib""", "applications"))
def linear_contrib(spark, d):
    c = _contrib_frame(spark, d, _classes(spark, d))
    long = c.select(F.col("application_id").cast("string").alias("scoring_event_id"), F.explode("factors").alias("f"))
    return rnd(long.select("scoring_event_id", "f.feature", "f.shap_value"), ["shap_value"], 9)


@query("global_importance", gf_sql(SCORE_SQL + """
select feature, mean_abs, cast(row_number() over (order by mean_abs desc, feature) as int) as rank
from (select feature, round(avg(abs(shap_value)), 9) as mean_abs from contrib group by feature)""", "applications"))
def global_importance(spark, d):
    return rnd(_contrib_frame(spark, d, _classes(spark, d)).transform(MD.global_importance), ["mean_abs"], 9)


def _contrib_frame(spark, d, classes):
    from lendnet.operators.features import derived_features as DF, graph_lookup, with_graph_defaults
    apps = FX.applications(spark, d)
    v = CL.validate_requests(apps).withColumns({f"_raw_{c}": F.col(c) for c in CAT_COLS})
    enc = CL.label_encode(v, classes, CAT_COLS)
    ok = enc.filter(F.col("accepted") & F.col("loan_grade").isNotNull() & F.col("loan_intent").isNotNull()
                    & F.col("person_home_ownership").isNotNull())
    feat = DF(graph_lookup(with_graph_defaults(ok), graph_features_view(spark, d)))
    # read for the means and for the attributions
    return MD.linear_contrib(cut_lineage(MD.scorecard_score(feat).select("application_id", *MD.SCORECARD)))


@query("encode_reject", gf_sql(CLASSES_SQL + """
select a.application_id, 'loan_grade' as "column", a.loan_grade as value from applications a
where cast(a.loan_grade as varchar) not in (select v from cls where col = 'loan_grade')
union all select a.application_id, 'loan_intent', a.loan_intent from applications a
where a.loan_intent not in (select v from cls where col = 'loan_intent')
union all select a.application_id, 'person_home_ownership', a.person_home_ownership from applications a
where a.person_home_ownership not in (select v from cls where col = 'person_home_ownership')""", "applications"))
def encode_reject(spark, d):
    return CL.encode_reject(FX.applications(spark, d), _classes(spark, d), CAT_COLS, "application_id")


@query("validate_requests", with_views("""
select application_id,
 (customer_id is not null and person_age between 18 and 100 and person_income > 0
  and person_home_ownership is not null and coalesce(person_emp_length >= 0, false) and loan_intent is not null
  and loan_grade is not null and loan_amnt > 0 and coalesce(loan_int_rate >= 0, false)
  and loan_percent_income >= 0 and coalesce(cb_person_cred_hist_length >= 0, false)
  and cb_person_default_on_file in (0, 1)) as accepted,
 (case when person_age < 18 or person_age > 100 or person_age is null then 1 else 0 end
  + case when person_income is null or person_income <= 0 then 1 else 0 end
  + case when person_emp_length is null or person_emp_length < 0 then 1 else 0 end
  + case when loan_amnt is null or loan_amnt <= 0 then 1 else 0 end
  + case when loan_percent_income is null or loan_percent_income < 0 then 1 else 0 end
  + case when cb_person_cred_hist_length is null or cb_person_cred_hist_length < 0 then 1 else 0 end
  + case when loan_int_rate is null or loan_int_rate < 0 then 1 else 0 end) as n_reasons
from applications""", "applications"))
def validate_requests(spark, d):
    v = CL.validate_requests(FX.applications(spark, d))
    return v.select("application_id", "accepted", F.size("reasons").alias("n_reasons"))


@query("graph_lookup", gf_sql("""
select a.application_id, coalesce(g.degree, 0) as degree, round(coalesce(g.pagerank, 0e0), 10) as pagerank,
 coalesce(g.distance_to_prior_default, -1) as distance_to_prior_default
from applications a left join gf g on g.customer_id = a.customer_id""", "applications"))
def graph_lookup(spark, d):
    g = graph_features_view(spark, d)
    r = FE.graph_lookup(FX.applications(spark, d), g)
    return rnd(r.select("application_id", "degree", "pagerank", "distance_to_prior_default"), ["pagerank"], 10)


@query("gbt_evaluate")
def gbt_evaluate(spark, d):
    """I2 + I4: boosted trees on the assembled features, evaluated on the held-out split."""
    from lendnet.operators.metrics import evaluate
    from lendnet.operators.order import stratified_split
    a, _ = _assembled(spark, d)
    split = stratified_split(a, "label", "customer_id", 42)
    model = MD.train_gbt(split.filter(F.col("split") == "train"))
    pred = MD.predict_proba(model, split.filter(F.col("split") == "test"))
    return evaluate(pred.select(F.col("label").alias("y"), F.col("risk_score").alias("p")))
