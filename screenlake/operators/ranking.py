"""Early-enrichment metrics: Hits/Precision at k, PlatePPV, diverse PlatePPV.

All use ``row_number() over (partition by group order by score desc, row_id)`` filtered to ``<= k``.  Spark plans it as a
WindowGroupLimit, which keeps the top k inside every map task before the shuffle, but sorts all rows for it.  So a bound comes
first: the k-th best row of a part of a group can't be better than the k-th best of all, and only rows up to it are ranked;
what a hot group's many tasks keep of them goes to ``SPREAD`` reducers, of which each passes on k rows.  ``row_id`` breaks ties
(the reference leaves ties to an unstable sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_null_safe
from ..functions.maths import safe_div
from ..session import cut_lineage


SPREAD = 32
SHARE = 64         # one row in so many, by hash, gives the bound
MOST_BOUNDS = 1 << 14


def _ranked(pred: DataFrame, keys: list[str], k: int, order: list, rank_col: str) -> DataFrame:
    return pred.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank_col) <= k)


def _bounded(pred: DataFrame, keys: list[str], k: int, rank_by: str, tiebreak: str, order: list) -> DataFrame:
    """The rows no worse than the k-th best of those in one of ``SHARE`` parts of their group; all rows of a group with fewer
    than k there, or of a table with many groups."""
    part = pred.filter(F.pmod(F.xxhash64(tiebreak), F.lit(SHARE)) == 0).select(*keys, rank_by, tiebreak)
    last = _ranked(part, keys, k, order, "_rank").filter(F.col("_rank") == k)
    bounds = last.select(*keys, F.col(rank_by).alias("_score"), F.col(tiebreak).alias("_tie"), F.lit(True).alias("_bound"))
    bounds = cut_lineage(bounds)
    if bounds.count() > MOST_BOUNDS:
        return pred
    near = join_null_safe(pred, F.broadcast(bounds), keys, "left")
    # in the order of the ranking: scores fall and nulls come last, ties rise and nulls come first
    better = F.coalesce(F.col(rank_by) > F.col("_score"), F.col(rank_by).isNotNull())
    equal = F.col(rank_by).eqNullSafe(F.col("_score"))
    before = F.coalesce(F.col(tiebreak) <= F.col("_tie"), F.col(tiebreak).isNull())
    return near.filter(F.col("_bound").isNull() | better | (equal & before)).drop("_score", "_tie", "_bound")


def top_k_rows(pred: DataFrame, keys: list[str], k: int, rank_by: str = "y_proba",
               tiebreak: str = "row_id", rank_col: str = "_rank", spread: int = SPREAD) -> DataFrame:
    """The first ``k`` rows of each group; with ``spread`` 1, for many small groups, by the window alone."""
    order = [F.col(rank_by).desc(), F.col(tiebreak).asc()]
    if spread > 1:
        near = _bounded(pred, keys, k, rank_by, tiebreak, order).withColumn("_part", F.pmod(F.xxhash64(tiebreak), F.lit(spread)))
        pred = _ranked(near, [*keys, "_part"], k, order, rank_col).drop("_part", rank_col)
    return _ranked(pred, keys, k, order, rank_col)


def hits_at_k(pred: DataFrame, keys: list[str], ks: tuple[int, ...] = (200, 500),
              score: str = "y_proba") -> DataFrame:
    """hits_at_k = #(true=1 & pred=1) in top k; precision_at_k = hits / #(pred=1) in top k, 0 if none."""
    top = top_k_rows(pred, keys, max(ks), rank_by=score)
    hit = (F.col("y_true") == 1) & (F.col("y_pred") == 1)
    aggs = []
    for k in ks:
        within = F.col("_rank") <= k
        aggs += [F.count_if(within & hit).alias(f"hits_at_{k}"),
                 F.count_if(within & (F.col("y_pred") == 1)).alias(f"_pp_{k}")]
    out = top.groupBy(*keys).agg(*aggs)
    cols = list(keys)
    for k in ks:
        cols += [f"hits_at_{k}", safe_div(f"hits_at_{k}", f"_pp_{k}").alias(f"precision_at_{k}")]
    return out.select(*cols)


def plate_ppv(pred: DataFrame, keys: list[str], top_n: int = 128, rank_by: str = "y_pred") -> DataFrame:
    """Top ``top_n`` by ``rank_by`` (the reference ranks by the hard label), keep pred=1,
    PPV = mean(y_true) among them, 0 if none."""
    top = top_k_rows(pred, keys, top_n, rank_by=rank_by)
    sel = F.col("y_pred") == 1
    out = top.groupBy(*keys).agg(F.count_if(sel & (F.col("y_true") == 1)).alias("_hits"),
                                 F.count_if(sel).alias("_sel"))
    return out.select(*keys, safe_div("_hits", "_sel").alias("plate_ppv"))


def diverse_plate_ppv(pred: DataFrame, keys: list[str], cluster_col: str = "cluster_id",
                      per_cluster: int = 15, score: str = "y_proba") -> DataFrame:
    """Per cluster: predicted positives only, top ``per_cluster`` by score, PPV; then the mean
    of cluster PPVs per group (clusters without predicted positives are skipped; 0 if none)."""
    pos = pred.filter(F.col("y_pred") == 1)
    top = top_k_rows(pos, keys + [cluster_col], per_cluster, rank_by=score, spread=1)
    per = top.groupBy(*keys, cluster_col).agg(F.avg(F.col("y_true").cast("double")).alias("_ppv"))
    groups = pred.select(*keys).distinct()
    mean = per.groupBy(*keys).agg(F.avg("_ppv").alias("_m"))
    return join_null_safe(groups, mean, keys, "left").select(
        *keys, F.coalesce(F.col("_m"), F.lit(0.0)).alias("diverse_plate_ppv"))
