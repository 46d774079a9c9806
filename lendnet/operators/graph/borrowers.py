"""Borrower columns of a bare lending network (edges with times, no borrower table).

Every endpoint becomes a customer. Fixed formulas over the network (net lending ratio, normalised in-degree, share
of the crisis window) give the prior-default probability, the means of income and loan, and the grade's rank score;
what is random in a borrower is a draw by md5 of (seed, customer, purpose), so the same network gives the same
borrowers on any cluster.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.functions.columns import clip, grade_from_score, hash_unit
from lendnet.operators.clean import loan_pct_income
from lendnet.operators.features import prior_default_prob
from lendnet.operators.graph import edges as GE
from lendnet.operators.order import rank_pctile
from lendnet.schemas import CRISIS_END, CRISIS_START, MISSING_TS
from lendnet.session import cut_lineage


def _normal(seed: int, purpose: str):
    """A standard normal draw of a customer (Box-Muller over two md5 draws)."""
    u, v = (hash_unit(F.lit(seed), F.col("customer_id"), F.lit(f"{purpose}{i}")) for i in (1, 2))
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(F.lit(2.0 * math.pi) * v)


def network_borrowers(edges: DataFrame, seed: int = 42, crisis: tuple[float, float] = (CRISIS_START, CRISIS_END)) -> DataFrame:
    """customer_id, net_ratio, crisis_exposure, prior_default_prob, cb_person_default_on_file (0/1), person_income,
    loan_amnt, loan_percent_income, income_pctile, loan_grade of every edge endpoint.

    ``edges``: src_customer_id, dst_customer_id, ts_epoch. An empty edge list has no borrowers; a node without a
    time counts as outside the crisis window at the stated default time."""
    nodes = GE.node_set(edges).filter("node IS NOT NULL").select(F.col("node").alias("customer_id"))
    deg = GE.net_ratio(GE.norm_degree(GE.degrees(nodes, edges)))
    times = GE.crisis_exposure(nodes, edges, *crisis, MISSING_TS).select("customer_id", "crisis_exposure")
    base = prior_default_prob(deg.join(times, "customer_id"))
    income = F.exp(F.lit(10.8) + F.lit(0.3) * F.col("net_ratio") + F.lit(0.7) * _normal(seed, "income"))
    loan = F.exp(F.log(F.greatest(F.col("person_income") * F.lit(0.15), F.lit(500.0))) + F.lit(0.6) * _normal(seed, "loan"))
    flag = hash_unit(F.lit(seed), F.col("customer_id"), F.lit("default")) < F.col("prior_default_prob")
    rows = (base.withColumn("person_income", F.floor(clip(income, 15000.0, 500000.0)).cast("double"))
            .withColumn("loan_amnt", F.floor(clip(loan, 500.0, 35000.0)).cast("double"))
            .withColumn("loan_percent_income", loan_pct_income(F.col("loan_amnt"), F.col("person_income")))
            .withColumn("cb_person_default_on_file", flag.cast("int")))
    ranked = rank_pctile(cut_lineage(rows), "person_income", "customer_id", "income_pctile")
    score = (F.col("income_pctile") * F.lit(0.6) + (F.lit(1.0) - F.col("norm_in_degree")) * F.lit(0.2)
             + F.lit(0.2) * hash_unit(F.lit(seed), F.col("customer_id"), F.lit("grade")))
    return ranked.withColumn("loan_grade", grade_from_score(score)).select(
        "customer_id", "net_ratio", "crisis_exposure", "prior_default_prob", "cb_person_default_on_file",
        "person_income", "loan_amnt", "loan_percent_income", "income_pctile", "loan_grade")
