"""Split-conformal prediction sets for binary classifiers (LAC score).

score_i = 1 - p(true class) on the calibration rows; with n calibration rows and
confidence c, q = the ceil((n + 1) * c)-th smallest score (+inf when that exceeds n);
class j is in a row's set iff 1 - p_j <= q (sets may be empty or hold both classes).
(Sadinle, Lei & Wasserman 2019; the usual split-conformal quantile.)

The k-th smallest score per model is found from a per-(model, score) histogram and a
distributed running count (``running_sums``), not from a sort of each model's rows in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_null_safe
from .prefix import running_sums


def nonconformity(pred: DataFrame) -> DataFrame:
    p_true = F.when(F.col("y_true") == 1, F.col("y_proba")).otherwise(1 - F.col("y_proba"))
    return pred.withColumn("score", 1 - p_true)


def kth_smallest(df: DataFrame, keys: list[str], value: str, k: DataFrame) -> DataFrame:
    """Per group the k-th smallest ``value`` (1-based); ``k`` has columns keys + ['k']."""
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(hist, keys, value, ["_c"])
    hit = join_null_safe(cum, k, keys).filter((F.col("cum__c") >= F.col("k")) & (F.col("cum__c") - F.col("_c") < F.col("k")))
    return hit.select(*keys, F.col(value).alias("kth"))


def conformal_threshold(calib: DataFrame, keys: list[str], confidence: float = 0.95) -> DataFrame:
    """(keys, n_cal, k, qhat); qhat = +inf when k > n_cal."""
    scored = nonconformity(calib)
    n = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cal"))
    k = n.withColumn("k", F.ceil((F.col("n_cal") + 1) * F.lit(confidence) - F.lit(1e-9)).cast("bigint"))
    kth = kth_smallest(scored, keys, "score", k.select(*keys, "k"))
    return join_null_safe(k, kth, keys, "left").select(
        *keys, "n_cal", "k",
        F.when(F.col("k") > F.col("n_cal"), F.lit(float("inf"))).otherwise(F.col("kth")).alias("qhat"))


def prediction_sets(pred: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """Attach ``pred_set`` (array of class ids, ascending) per row.  ``thresholds`` has one
    row per model (tiny), joined by key."""
    j = join_null_safe(pred, thresholds.select(*keys, "qhat"), keys)
    p = F.col("y_proba")
    in0 = (p <= F.col("qhat"))            # 1 - p0 = p
    in1 = ((1 - p) <= F.col("qhat"))
    sets = F.filter(F.array(F.when(in0, F.lit(0)), F.when(in1, F.lit(1))), lambda c: c.isNotNull())
    return j.withColumn("pred_set", sets)


def coverage(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Share of rows whose true label is in the set; mean set size; confidence = 2 - size."""
    agg = sets.groupBy(*keys).agg(
        F.avg(F.array_contains("pred_set", F.col("y_true")).cast("double")).alias("coverage"),
        F.avg(F.size("pred_set").cast("double")).alias("mean_set_size"))
    return agg.withColumn("set_confidence", F.lit(2.0) - F.col("mean_set_size"))


def union_set(sets: DataFrame) -> DataFrame:
    """One global set: every class id predicted in any row by any model (bounded by #classes)."""
    return sets.select(F.explode("pred_set").alias("c")).agg(
        F.array_sort(F.collect_set("c")).alias("union_conformal_set"))
