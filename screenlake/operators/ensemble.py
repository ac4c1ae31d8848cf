"""Ensembles over a long prediction table: wide score columns, mean probability, majority vote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scores_pivot(pred: DataFrame, key: str, models: list[str], value: str = "y_proba") -> DataFrame:
    """One column ``model_<m>_yprob`` per model.  The model list is given, so pivot needs no
    extra distinct() job and the output schema is fixed."""
    wide = pred.groupBy(key).pivot("model_id", models).agg(F.first(value))
    return wide.select(key, *[F.col(m).alias(f"model_{m}_yprob") for m in models])


def ensemble(pred: DataFrame, keys: list[str]) -> DataFrame:
    """Per row: average probability (unweighted) and majority vote of hard labels.
    The vote rounds half to even, so a 50/50 split votes 0 (as numpy's round)."""
    return pred.groupBy(*keys).agg(
        F.avg("y_proba").alias("average_yprob"),
        F.bround(F.avg(F.col("y_pred").cast("double")), 0).cast("int").alias("vote"),
        F.first("y_true").alias("y_true"))


def fused_predictions(pred: DataFrame, keys: list[str]) -> DataFrame:
    """Fused model as a prediction table: y_proba = mean probability, y_pred = vote."""
    e = ensemble(pred, keys)
    return e.select(*keys, "y_true", F.col("average_yprob").alias("y_proba"), F.col("vote").alias("y_pred"))
