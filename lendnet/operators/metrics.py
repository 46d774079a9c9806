"""Classifier metrics from (label, score) tables, exact and distributed.

Everything starts from a score histogram (one row per distinct score with its
positive / negative counts), so ties are handled exactly and the ordered part of
the job (prefix sums) runs on distinct scores, range-partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.order import prefix_sum
from lendnet.session import cut_lineage


def score_histogram(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    return (df.groupBy(F.col(score).alias("score"))
            .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                 F.sum((F.lit(1) - F.col(label)).cast("long")).alias("neg")))


def _auc(h: DataFrame) -> DataFrame:
    c = prefix_sum(h, ["score"], ["neg"], inclusive=False)
    return c.agg((F.sum(F.col("pos").cast("double") * (F.col("neg_cum") + F.col("neg") / F.lit(2.0)))
                  / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Exact ROC-AUC with ties: sum(pos * (neg below + neg / 2)) / (P * N)."""
    return _auc(score_histogram(df, label, score))


def _curve(hist: DataFrame) -> DataFrame:
    h = hist.withColumn("neg_score", -F.col("score"))
    c = prefix_sum(h, ["neg_score"], ["pos", "neg"])      # counts at scores >= threshold
    total_pos = h.agg(F.sum("pos")).scalar()
    return c.select(F.col("score").alias("threshold"), F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                    F.coalesce(F.try_divide(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum")), F.lit(0.0))
                    .alias("precision"),
                    F.coalesce(F.try_divide(F.col("pos_cum"), total_pos), F.lit(0.0)).alias("recall"))


def pr_curve(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """(threshold, tp, fp, precision, recall) at every distinct score; predicted positive = p >= t."""
    return _curve(score_histogram(df, label, score))


def _best(curve: DataFrame) -> DataFrame:
    c = curve.withColumn("f1", F.lit(2.0) * F.col("precision") * F.col("recall")
                         / (F.col("precision") + F.col("recall") + F.lit(1e-8)))
    return c.agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"),
                 F.max("f1").alias("f1"))


def best_threshold(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Threshold maximising 2pr / (p + r + 1e-8); the lowest threshold wins a tie."""
    return _best(pr_curve(df, label, score))


def _at_threshold(h: DataFrame, t) -> DataFrame:
    hit, miss = F.col("score") >= t, F.col("score") < t
    agg = h.agg(*[F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0)).cast("double").alias(name) for name, side, c in (
        ("tp", hit, "pos"), ("fp", hit, "neg"), ("fn", miss, "pos"), ("tn", miss, "neg"))])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return agg.select(
        (F.try_divide(tp + tn, tp + fp + fn + tn)).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        F.coalesce(F.try_divide(F.lit(2.0) * prec * rec, prec + rec), F.lit(0.0)).alias("f1"))


def clf_metrics(df: DataFrame, threshold, label: str = "y", score: str = "p") -> DataFrame:
    """Accuracy, precision, recall, F1 at ``threshold`` (a number or a scalar Column); 0 on 0/0."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return _at_threshold(score_histogram(df, label, score), t)


def evaluate(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Six metrics: accuracy, precision, recall, F1 at the best-F1 threshold, ROC-AUC, threshold.

    The input is read once: threshold, confusion counts and AUC all come from its stored histogram.
    """
    h = cut_lineage(score_histogram(df, label, score))
    t = _best(_curve(h)).select("threshold").scalar()
    return _at_threshold(h, t).select("*", _auc(h).scalar().alias("roc_auc"), t.alias("optimal_threshold"))


def class_weight(df: DataFrame, label: str = "y") -> DataFrame:
    """(n_neg, n_pos, weight = neg / pos, 1.0 when there are no positives)."""
    a = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("n_neg"),
               F.sum((F.col(label) == 1).cast("long")).alias("n_pos"))
    return a.withColumn("pos_weight", F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).otherwise(1.0))


def quality_gate(metrics: DataFrame, gate: float = 0.72, metric: str = "roc_auc") -> DataFrame:
    """I8: pass flag per metrics row."""
    return metrics.withColumn("passed", F.col(metric) >= F.lit(gate))
