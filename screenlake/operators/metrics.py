"""Classification and ranking metrics over a long prediction table.

Input: one row per prediction with ``y_true`` (0/1), ``y_pred`` (0/1), ``y_proba``
(score for class 1) and group keys (e.g. model_id, test_file).  Every metric is an
aggregate per group; many groups are evaluated in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maths import safe_div
from .prefix import running_sums

TRUE, PRED, PROBA = "y_true", "y_pred", "y_proba"


def confusion_counts(pred: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp, tn, fn, n per group in one pass (map-side partial aggregation)."""
    t, p = F.col(TRUE), F.col(PRED)
    return pred.groupBy(*keys).agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    )


def basic_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, Precision, Recall, F1 (zero division -> 0) from confusion counts."""
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    return counts.select(
        "*",
        safe_div(tp + tn, n).alias("accuracy"),
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def agreement_metrics(counts: DataFrame) -> DataFrame:
    """MCC (0 when a margin is empty), Cohen kappa (NULL when chance agreement is 1),
    balanced accuracy (mean recall over classes present in y_true)."""
    tp, fp, tn, fn, n = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn", "n"))
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(den == 0, F.lit(0.0)).otherwise((tp * tn - fp * fn) / den)
    po = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    kappa = F.when(pe == 1, F.lit(None).cast("double")).otherwise((po - pe) / (1 - pe))
    pos_recall = F.when(tp + fn > 0, tp / (tp + fn))
    neg_recall = F.when(tn + fp > 0, tn / (tn + fp))
    present = F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0)
    balanced = (F.coalesce(pos_recall, F.lit(0.0)) + F.coalesce(neg_recall, F.lit(0.0))) / present
    return counts.select("*", mcc.alias("mcc"), kappa.alias("cohen_kappa"),
                         balanced.alias("balanced_accuracy"))


COUNTERS = ("pos", "neg", "pos_pred", "neg_pred", "rows")
STATE_ROWS = 1 << 18     # rows of a state that one task aggregates or sorts


def state_parts(pred: DataFrame, keys: list[str], score: str = PROBA) -> int | None:
    """Partitions for a state with too many rows for the session's number of them, by the (approximate) count of its rows;
    else None.  A state compresses so well in the shuffle that sizes alone give tasks of many million rows."""
    usual = int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pred.count() <= usual * STATE_ROWS:
        return None
    rows = pred.agg(F.approx_count_distinct(F.struct(*keys, score))).first()[0]
    return max(usual + 1, -(-rows // STATE_ROWS)) if rows > usual * STATE_ROWS else None


def evaluation_state(pred: DataFrame, keys: list[str], score: str = PROBA, parts: int | None = None) -> DataFrame:
    """One row per (group, distinct score) with what every count and curve needs: positives and negatives, those of them
    predicted 1, all rows.  States of parts of a table add up (``merged_state``).  ``parts`` partitions (``state_parts``), where
    rows are dealt before they are aggregated, since most of them have a score of their own."""
    if parts:
        pred = pred.select(*keys, score, TRUE, PRED).repartition(parts, *keys, score)
    t, p = F.col(TRUE), F.col(PRED)
    return pred.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(t == 1).alias("pos"), F.count_if(t == 0).alias("neg"),
        F.count_if((t == 1) & (p == 1)).alias("pos_pred"), F.count_if((t == 0) & (p == 1)).alias("neg_pred"),
        F.count(F.lit(1)).alias("rows"))


def merged_state(states: list[DataFrame], keys: list[str], parts: int | None = None) -> DataFrame:
    """The state of several states' rows together, grouped by ``keys`` (some of theirs)."""
    columns = [*keys, "score", *COUNTERS]
    every = reduce(DataFrame.unionByName, [s.select(*columns) for s in states])
    every = every.repartition(parts, *keys, "score") if parts else every
    return every.groupBy(*keys, "score").agg(*[F.sum(c).alias(c) for c in COUNTERS])


def state_metrics(state: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """tp, fp, tn, fn, n, AUC-ROC (tie-averaged) and AUC-PR as average precision (step sum) of every group of a state.

    AUC = sum_s pos(s) * (neg below s + neg(s)/2) / (P * N)
    AP  = sum_s pos(s)/P * TP(>= s) / (TP(>= s) + FP(>= s))
    AUC is NULL for a group with a single class, AP for one without positives.
    """
    cum = running_sums(state, keys, "score", ["pos", "neg"], buckets=buckets, totals="all_")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp_ge = F.col("all_pos") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("all_neg") - (F.col("cum_neg") - F.col("neg"))
    terms = cum.select("*", (pos * (F.col("cum_neg") - F.col("neg") + neg / 2.0)).alias("_auc"),
                       F.when(F.col("pos") > 0, pos * tp_ge / (tp_ge + fp_ge)).otherwise(0.0).alias("_ap"))
    agg = terms.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*COUNTERS, "_auc", "_ap")])
    P, N = F.col("pos").cast("double"), F.col("neg").cast("double")
    return agg.select(
        *keys, F.col("pos_pred").alias("tp"), F.col("neg_pred").alias("fp"),
        (F.col("neg") - F.col("neg_pred")).alias("tn"), (F.col("pos") - F.col("pos_pred")).alias("fn"), F.col("rows").alias("n"),
        F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("_auc") / (P * N)).alias("auc_roc"),
        F.when(F.col("pos") > 0, F.col("_ap") / P).alias("average_precision"))


def ranked_metrics(pred: DataFrame, keys: list[str], score: str = PROBA, buckets: int | None = None) -> DataFrame:
    """AUC-ROC and average precision per group."""
    parts = state_parts(pred, keys, score)
    return state_metrics(evaluation_state(pred, keys, score, parts), keys, buckets or parts).select(*keys, "auc_roc", "average_precision")


def auc_roc(pred: DataFrame, keys: list[str], score: str = PROBA) -> DataFrame:
    return ranked_metrics(pred, keys, score).select(*keys, "auc_roc")


def average_precision(pred: DataFrame, keys: list[str], score: str = PROBA) -> DataFrame:
    return ranked_metrics(pred, keys, score).select(*keys, "average_precision")
