"""Metric queries over the ``scored`` prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maths import round6
from ..operators import metrics as M
from ..operators import ranking as R
from ..operators.evaluation import METRIC_COLUMNS, evaluate, fold_means
from . import fixtures as fx
from .catalog import register
from .fixture_sql import md5_bits_sql, with_views

KEYS = ["model_id", "test_file"]


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (the oracle does the same)."""
    return df.select(*[round6(f.name, f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


# ---- shared SQL fragments -------------------------------------------------

def counts_sql(src: str, keys: str = "model_id, test_file") -> str:
    return f"""SELECT {keys},
        count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
        count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
        count(*) AS n
      FROM {src} GROUP BY {keys}"""


BASIC_SQL = """
    round(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn)::DOUBLE / n END, 6) AS accuracy,
    round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
    round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1"""

AGREE_SQL = """
    round(CASE WHEN (tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
          ELSE (tp::DOUBLE * tn - fp::DOUBLE * fn)
               / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc,
    round(CASE WHEN pe = 1 THEN NULL ELSE (po - pe) / (1 - pe) END, 6) AS cohen_kappa,
    round((coalesce(CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END, 0.0)
         + coalesce(CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) END, 0.0))
         / ((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)), 6)
         AS balanced_accuracy"""

PO_PE_SQL = """(tp + tn)::DOUBLE / n AS po,
    ((tp + fp)::DOUBLE * (tp + fn) + (tn + fn)::DOUBLE * (tn + fp)) / (n::DOUBLE * n) AS pe"""


def ranked_sql(src: str, keys: str = "model_id, test_file", score: str = "y_proba") -> str:
    """AUC-ROC and average precision per group (simple windows; oracle only)."""
    return f"""(
      WITH h AS (SELECT {keys}, {score} AS s,
                        count(*) FILTER (WHERE y_true = 1) AS p,
                        count(*) FILTER (WHERE y_true = 0) AS n
                 FROM {src} GROUP BY {keys}, {score}),
      c AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn,
                   sum(p) OVER g AS tot_p, sum(n) OVER g AS tot_n
            FROM h WINDOW w AS (PARTITION BY {keys} ORDER BY s
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                          g AS (PARTITION BY {keys}))
      SELECT {keys},
        round(CASE WHEN max(tot_p) > 0 AND max(tot_n) > 0 THEN
              sum(p * ((cn - n) + n / 2.0))::DOUBLE / (max(tot_p)::DOUBLE * max(tot_n)::DOUBLE) END, 6)
              AS auc_roc,
        round(CASE WHEN max(tot_p) > 0 THEN
              sum(CASE WHEN p > 0 THEN p * (tot_p - (cp - p))::DOUBLE
                                       / ((tot_p - (cp - p)) + (tot_n - (cn - n))) ELSE 0 END)::DOUBLE
              / max(tot_p)::DOUBLE END, 6) AS average_precision
      FROM c GROUP BY {keys})"""


def topk_sql(src: str, ks=(200, 500), keys: str = "model_id, test_file") -> str:
    cols = []
    for k in ks:
        cols.append(f"count(*) FILTER (WHERE rk <= {k} AND y_true = 1 AND y_pred = 1) AS hits_at_{k}")
        cols.append(f"""round(CASE WHEN count(*) FILTER (WHERE rk <= {k} AND y_pred = 1) = 0 THEN 0.0
            ELSE (count(*) FILTER (WHERE rk <= {k} AND y_true = 1 AND y_pred = 1))::DOUBLE
                 / count(*) FILTER (WHERE rk <= {k} AND y_pred = 1) END, 6) AS precision_at_{k}""")
    return f"""(SELECT {keys}, {', '.join(cols)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY y_proba DESC, row_id) AS rk
        FROM {src}) WHERE rk <= {max(ks)} GROUP BY {keys})"""


def plate_sql(src: str, top_n: int = 128, keys: str = "model_id, test_file") -> str:
    return f"""(SELECT {keys},
        round(CASE WHEN count(*) FILTER (WHERE y_pred = 1) = 0 THEN 0.0
              ELSE (count(*) FILTER (WHERE y_pred = 1 AND y_true = 1))::DOUBLE
                   / count(*) FILTER (WHERE y_pred = 1) END, 6) AS plate_ppv
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY y_pred DESC, row_id) AS rk
            FROM {src}) WHERE rk <= {top_n} GROUP BY {keys})"""


def diverse_sql(src: str, keys: str = "model_id, test_file", per_cluster: int = 15) -> str:
    return f"""(SELECT {keys}, round(coalesce(avg(c.ppv), 0.0), 6) AS diverse_plate_ppv
      FROM (SELECT DISTINCT {keys} FROM {src}) g
      LEFT JOIN (SELECT {keys}, cluster_id, avg(y_true) AS ppv
                 FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, cluster_id ORDER BY y_proba DESC, row_id) AS rk
                       FROM {src} WHERE y_pred = 1)
                 WHERE rk <= {per_cluster} GROUP BY {keys}, cluster_id) c USING ({keys})
      GROUP BY {keys})"""


def eval_select(src: str, keys: str = "model_id, test_file") -> str:
    """All sixteen metrics of a prediction table with clusters."""
    return f"""
    SELECT {keys}, b.accuracy, b.precision, b.recall, b.f1, r.auc_roc, r.average_precision,
           g.mcc, g.cohen_kappa, g.balanced_accuracy, p.plate_ppv, d.diverse_plate_ppv,
           h.hits_at_200, h.precision_at_200, h.hits_at_500, h.precision_at_500, b.tp AS total_hits
    FROM (SELECT {keys}, tp, {BASIC_SQL} FROM ({counts_sql(src, keys)})) b
    JOIN (SELECT {keys}, {AGREE_SQL} FROM (SELECT *, {PO_PE_SQL} FROM ({counts_sql(src, keys)}))) g USING ({keys})
    JOIN {ranked_sql(src, keys)} r USING ({keys})
    JOIN {topk_sql(src, keys=keys)} h USING ({keys})
    JOIN {plate_sql(src, keys=keys)} p USING ({keys})
    JOIN {diverse_sql(src, keys)} d USING ({keys})"""


def unrounded(sql: str) -> str:
    return sql.replace("round(", "(").replace(", 6)", ")")


# ---- queries ----------------------------------------------------------------

@register("threshold_scores", with_views("""
    SELECT test_file, y_pred, count(*) AS n_rows,
           count(*) FILTER (WHERE y_proba = 0.5) AS n_at_half,
           round(min(y_proba), 6) AS min_proba, round(max(y_proba), 6) AS max_proba
    FROM scored GROUP BY test_file, y_pred""", "scored"))
def q_threshold_scores(spark, sf):
    s = fx.scored(spark, sf)  # y_pred = (y_proba > 0.5): strict, 0.5 -> class 0
    return rounded(s.groupBy("test_file", "y_pred").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("y_proba") == 0.5).alias("n_at_half"),
        F.min("y_proba").alias("min_proba"), F.max("y_proba").alias("max_proba")))


@register("hits_at_k", with_views(f"SELECT * FROM {topk_sql('scored')}", "scored"))
def q_hits_at_k(spark, sf):
    return rounded(R.hits_at_k(fx.scored(spark, sf), KEYS, (200, 500)))


@register("hits_at_k_ties", with_views(f"SELECT * FROM {topk_sql('scored_ties')}", "scored_ties"))
def q_hits_at_k_ties(spark, sf):
    return rounded(R.hits_at_k(fx.scored_ties(spark, sf), KEYS, (200, 500)))


@register("confusion_counts", with_views(counts_sql("scored"), "scored"))
def q_confusion_counts(spark, sf):
    return M.confusion_counts(fx.scored(spark, sf), KEYS)


@register("basic_metrics", with_views(
    f"SELECT model_id, test_file, tp, fp, tn, fn, n, {BASIC_SQL} FROM ({counts_sql('scored')})",
    "scored"))
def q_basic_metrics(spark, sf):
    return rounded(M.basic_metrics(M.confusion_counts(fx.scored(spark, sf), KEYS)))


@register("agreement_metrics", with_views(
    f"SELECT model_id, test_file, {AGREE_SQL} FROM (SELECT *, {PO_PE_SQL} FROM ({counts_sql('scored')}))",
    "scored"))
def q_agreement_metrics(spark, sf):
    out = M.agreement_metrics(M.confusion_counts(fx.scored(spark, sf), KEYS))
    return rounded(out.select(*KEYS, "mcc", "cohen_kappa", "balanced_accuracy"))


@register("auc_roc", with_views(f"SELECT model_id, test_file, auc_roc FROM {ranked_sql('scored')}",
                                "scored"))
def q_auc_roc(spark, sf):
    return rounded(M.auc_roc(fx.scored(spark, sf), KEYS))


@register("auc_roc_ties", with_views(
    f"SELECT model_id, test_file, auc_roc, average_precision FROM {ranked_sql('scored_ties')}",
    "scored_ties"))
def q_auc_roc_ties(spark, sf):
    return rounded(M.ranked_metrics(fx.scored_ties(spark, sf), KEYS))


@register("average_precision", with_views(
    f"SELECT model_id, test_file, average_precision FROM {ranked_sql('scored')}", "scored"))
def q_average_precision(spark, sf):
    return rounded(M.average_precision(fx.scored(spark, sf), KEYS))


@register("plate_ppv", with_views(f"SELECT * FROM {plate_sql('scored')}", "scored"))
def q_plate_ppv(spark, sf):
    return rounded(R.plate_ppv(fx.scored(spark, sf), KEYS, 128))


def clustered(spark, sf):
    """``scored`` with a cluster for each row: the supplier, last part of its key."""
    return fx.scored(spark, sf).withColumn("cluster_id", F.element_at(F.split("row_id", "-"), -1).cast("bigint"))


CLUSTERED_SQL = ("clustered", "SELECT *, CAST(split_part(row_id, '-', 4) AS BIGINT) AS cluster_id FROM scored")


# CV metrics: fold = pmod(md5 bits of row_id, 2); all metrics per fold, then their unweighted means.
@register("cv_mean_metrics", with_views(f"""
    SELECT model_id, test_file, count(*) AS n_folds, {', '.join(f'round(avg({m}), 6) AS cv_{m}' for m in METRIC_COLUMNS)}
    FROM ({unrounded(eval_select('folded', 'model_id, test_file, fold'))})
    GROUP BY model_id, test_file""", "scored", extra=[
        CLUSTERED_SQL, ("folded", f"SELECT *, {md5_bits_sql('row_id')} % 2 AS fold FROM clustered")]))
def q_cv_mean_metrics(spark, sf):
    return rounded(fold_means(evaluate(fx.folded(clustered(spark, sf)), KEYS + ["fold"], materialize=True), KEYS))


# ranked metrics of whole test files from the states of their folds
@register("merged_state_metrics", with_views(f"""
    SELECT model_id, tp, fp, tn, fn, n, auc_roc, average_precision
    FROM ({counts_sql('scored', 'model_id')}) JOIN {ranked_sql('scored', 'model_id')} USING (model_id)""", "scored"))
def q_merged_state_metrics(spark, sf):
    s = fx.scored(spark, sf)
    parts = M.state_parts(s, KEYS)
    files = [M.evaluation_state(s.filter(F.col("test_file") == f), KEYS, parts=parts) for f in ("F", "O")]
    return rounded(M.state_metrics(M.merged_state(files, ["model_id"], parts), ["model_id"], parts))


EVAL_SELECT = eval_select("clustered")
EVAL_SQL = with_views(EVAL_SELECT, "scored", extra=[CLUSTERED_SQL])


@register("evaluate_all", EVAL_SQL)
def q_evaluate_all(spark, sf):
    return rounded(evaluate(clustered(spark, sf), KEYS))
