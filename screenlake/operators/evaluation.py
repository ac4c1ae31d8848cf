"""All sixteen ledger metrics for every (model, test file) group of a prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_null_safe
from ..session import stored

from . import metrics as M
from . import ranking as R

METRIC_COLUMNS = ["accuracy", "precision", "recall", "f1", "auc_roc", "average_precision", "mcc",
                  "cohen_kappa", "balanced_accuracy", "plate_ppv", "diverse_plate_ppv",
                  "hits_at_200", "precision_at_200", "hits_at_500", "precision_at_500", "total_hits"]


def evaluate(pred: DataFrame, keys: list[str], clusters: DataFrame | None = None,
             cluster_col: str = "cluster_id", materialize: bool = False) -> DataFrame:
    """One row per group.  ``clusters`` (row_id, cluster_id), or a column of that name in ``pred``, gives DiversePlatePPV, else NULL.

    Counts and curves come from one state (a row per group and score), the top rows from two bounded rankings; the joins
    below are between tables with one row per group (sized by the number of models x test files).
    """
    if clusters is not None:
        pred = pred.drop(cluster_col).join(clusters.select("row_id", cluster_col), "row_id", "left")
    clustered = cluster_col in pred.columns
    cols = list(dict.fromkeys([*keys, "row_id", "y_true", "y_pred", "y_proba", *([cluster_col] if clustered else [])]))
    pred = pred.select(*cols)
    if materialize:
        # a *derived* prediction table (a model transform, a fused ensemble, hashed scores) is computed once into the shared
        # folder; a stored table is simply re-scanned (narrow columns), never rewritten
        pred = stored(pred, "predictions")
    parts = M.state_parts(pred, keys)
    out = M.agreement_metrics(M.basic_metrics(M.state_metrics(M.evaluation_state(pred, keys, parts=parts), keys, parts)))
    for part in (R.hits_at_k(pred, keys, (200, 500)), R.plate_ppv(pred, keys, 128)):
        out = join_null_safe(out, part, keys)
    if clustered:
        out = join_null_safe(out, R.diverse_plate_ppv(pred.filter(F.col(cluster_col).isNotNull()), keys, cluster_col), keys, "left")
    else:
        out = out.withColumn("diverse_plate_ppv", F.lit(None).cast("double"))
    out = out.withColumn("total_hits", F.col("tp"))
    return out.select(*keys, *METRIC_COLUMNS)


def fold_means(per_fold: DataFrame, keys: list[str], prefix: str = "cv_") -> DataFrame:
    """Unweighted mean of every metric over the folds of each group; a metric that is NULL on a fold is left out of its mean."""
    return per_fold.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_folds"),
                                       *[F.avg(F.col(m).cast("double")).alias(f"{prefix}{m}") for m in METRIC_COLUMNS])
