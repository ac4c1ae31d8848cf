"""Ensemble and conformal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conformal as C
from ..operators import ensemble as EN
from ..operators import ranking as R
from ..operators import sampling as S
from ..operators import similarity as SIM
from ..operators.evaluation import evaluate
from ..session import cut_lineage
from . import fixtures as fx
from .catalog import register
from .fixture_sql import VIEWS, md5_bits_sql, with_views
from .metric_queries import eval_select, rounded
from .similarity_queries import LEADER_SIM, MAX_DISTANCE, leaders_sql

MODELS = fx.MODELS
CONFIDENCE = 0.95
SEED = 42

FUSED_SQL = ("fused", """
    SELECT row_id, 'embeddings' AS test_file, any_value(y_true) AS y_true,
           avg(y_proba) AS y_proba, CAST(round_even(avg(y_pred), 0) AS INTEGER) AS y_pred
    FROM multi_scored GROUP BY row_id""")

# Nested split: the first 20 % of the seeded order are test rows; of the rest 30 % calibrate, and the scorers are fitted on what
# remains, the proper part, alone.
TEST_SIZE, CALIBRATION_SIZE = 0.2, 0.3


def _refitted(name: str) -> tuple[str, str]:
    """A fixture view of the scorers, fitted on the proper rows only."""
    sql = VIEWS[name][1].replace("(SELECT avg(y) FROM vectors)", "(SELECT avg(y) FROM vectors JOIN split USING (row_id) WHERE split = 'proper')")
    sql = sql.replace("FROM ms_ex GROUP BY pos", "FROM ms_ex JOIN split USING (row_id) WHERE split = 'proper' GROUP BY pos")
    return f"{name}_p", sql.replace("ms_stats", "ms_stats_p").replace("FROM ms_per", "FROM ms_per_p")


CALIB_SQL = [
    ("placed", f"""SELECT row_id, row_number() OVER (ORDER BY {md5_bits_sql("'42|' || row_id")}, row_id) AS k,
                          ceil(count(*) OVER () * {TEST_SIZE} - 1e-9) AS n_test, count(*) OVER () AS n FROM vectors"""),
    ("split", f"""SELECT row_id, CASE WHEN k <= n_test THEN 'test'
                                     WHEN k <= n_test + ceil((n - n_test) * {CALIBRATION_SIZE} - 1e-9) THEN 'calibration'
                                     ELSE 'proper' END AS split FROM placed"""),
    _refitted("ms_stats"), _refitted("ms_per"), _refitted("multi_scored"),
    ("cal_scores", """SELECT m.model_id, 1 - CASE WHEN y_true = 1 THEN y_proba ELSE 1 - y_proba END AS score
                      FROM multi_scored_p m JOIN split s USING (row_id) WHERE s.split = 'calibration'"""),
    ("qhat", f"""SELECT model_id, n_cal, k,
                        CASE WHEN k > n_cal THEN 'Infinity'::DOUBLE ELSE kth END AS qhat
                 FROM (SELECT model_id, count(*) AS n_cal,
                              CAST(ceil((count(*) + 1) * {CONFIDENCE} - 1e-9) AS BIGINT) AS k
                       FROM cal_scores GROUP BY model_id) n
                 LEFT JOIN (SELECT model_id, score AS kth,
                                   row_number() OVER (PARTITION BY model_id ORDER BY score) AS rn
                            FROM cal_scores) s USING (model_id)
                 WHERE s.rn = n.k OR n.k > n.n_cal"""),
    ("sets", """SELECT m.row_id, m.model_id, m.y_true, s.split,
                       [c FOR c IN [CASE WHEN m.y_proba <= q.qhat THEN 0 END,
                                    CASE WHEN 1 - m.y_proba <= q.qhat THEN 1 END] IF c IS NOT NULL] AS pred_set
                FROM multi_scored_p m JOIN qhat q USING (model_id) JOIN split s USING (row_id) WHERE s.split = 'test'"""),
]


def _calibrated_sets(spark, sf):
    """Sets of the test rows, from scorers that saw neither these nor the calibration rows."""
    v = fx.vectors(spark, sf)
    split = S.nested_split(v.select("row_id"), "row_id", TEST_SIZE, CALIBRATION_SIZE, SEED)
    parts = cut_lineage(v.join(split, "row_id"))
    scored = fx.score_with(parts, fx.fit_class_stats(parts.filter(F.col("split") == "proper")), "split")
    scored = cut_lineage(scored.filter(F.col("split") != "proper"))   # read by the quantile and by the sets
    q = C.conformal_threshold(scored.filter(F.col("split") == "calibration"), ["model_id"], CONFIDENCE)
    return C.prediction_sets(scored.filter(F.col("split") == "test"), q, ["model_id"]), q


@register("scores_pivot", with_views(
    "SELECT row_id, " + ", ".join(
        f"max(y_proba) FILTER (WHERE model_id = '{m}') AS model_{m}_yprob" for m in MODELS)
    + " FROM multi_scored GROUP BY row_id", "multi_scored"))
def q_scores_pivot(spark, sf):
    return EN.scores_pivot(fx.multi_scored(spark, sf), "row_id", MODELS)


@register("ensemble_mean", with_views(
    "SELECT row_id, round(avg(y_proba), 8) AS average_yprob FROM multi_scored GROUP BY row_id",
    "multi_scored"))
def q_ensemble_mean(spark, sf):
    # inputs have 6 decimals, so the mean of 4 is exact at 8 (6 would hit rounding ties)
    e = EN.ensemble(fx.multi_scored(spark, sf), ["row_id"])
    return e.select("row_id", F.round("average_yprob", 8).alias("average_yprob"))


@register("ensemble_vote", with_views(
    "SELECT row_id, CAST(round_even(avg(y_pred), 0) AS INTEGER) AS vote, "
    "CAST(sum(y_pred) AS BIGINT) AS n_positive_votes FROM multi_scored GROUP BY row_id", "multi_scored"))
def q_ensemble_vote(spark, sf):
    ms = fx.multi_scored(spark, sf)
    votes = EN.ensemble(ms, ["row_id"]).select("row_id", "vote")
    n = ms.groupBy("row_id").agg(F.sum("y_pred").alias("n_positive_votes"))
    return votes.join(n, "row_id")


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


FUSED_CLUSTERED_SQL = [*leaders_sql(LEADER_SIM), FUSED_SQL,
                       ("fused_clustered", "SELECT f.*, a.cluster_id FROM fused f LEFT JOIN assigned a USING (row_id)")]


def _clusters(spark, sf):
    v = fx.vectors(spark, sf)
    leaders = SIM.leader_pick(v, "row_id", "bits", MAX_DISTANCE)
    return SIM.assign_to_leaders(v, "row_id", "bits", leaders, MAX_DISTANCE).select("row_id", "cluster_id")


@register("fusion_metrics", _recursive(with_views(eval_select("fused_clustered", "test_file"), "multi_scored", extra=FUSED_CLUSTERED_SQL)))
def q_fusion_metrics(spark, sf):
    fused = EN.fused_predictions(fx.multi_scored(spark, sf), ["row_id", "test_file"])
    return rounded(evaluate(fused, ["test_file"], _clusters(spark, sf), materialize=True))


@register("conformal_threshold", with_views(
    "SELECT model_id, n_cal, k, round(qhat, 6) AS qhat FROM qhat", "vectors", "ms_ex", extra=CALIB_SQL))
def q_conformal_threshold(spark, sf):
    _, q = _calibrated_sets(spark, sf)
    return rounded(q)


@register("conformal_sets", with_views(
    "SELECT row_id, model_id, array_to_string(pred_set, ',') AS pred_set, len(pred_set) AS set_size "
    "FROM sets", "vectors", "ms_ex", extra=CALIB_SQL))
def q_conformal_sets(spark, sf):
    sets, _ = _calibrated_sets(spark, sf)
    return sets.select("row_id", "model_id", F.array_join("pred_set", ",").alias("pred_set"),
                       F.size("pred_set").cast("bigint").alias("set_size"))


@register("conformal_coverage", with_views("""
    SELECT model_id, round(avg(CAST(list_contains(pred_set, y_true) AS DOUBLE)), 6) AS coverage,
           round(avg(len(pred_set)), 6) AS mean_set_size, round(2.0 - avg(len(pred_set)), 6) AS set_confidence
    FROM sets GROUP BY model_id""", "vectors", "ms_ex", extra=CALIB_SQL))
def q_conformal_coverage(spark, sf):
    sets, _ = _calibrated_sets(spark, sf)
    return rounded(C.coverage(sets, ["model_id"]))


@register("conformal_union_set", with_views("""
    SELECT DISTINCT row_id, (SELECT array_to_string(list_sort(list_distinct(flatten(list(pred_set)))), ',')
                             FROM sets) AS union_conformal_set
    FROM sets""", "vectors", "ms_ex", extra=CALIB_SQL))
def q_conformal_union_set(spark, sf):
    sets, _ = _calibrated_sets(spark, sf)
    u = C.union_set(sets).select(F.array_join("union_conformal_set", ",")).scalar()
    # the single global set is broadcast to every row (as the reference does)
    return sets.select("row_id").distinct().withColumn("union_conformal_set", u)


def _diverse_sql() -> str:
    sql = with_views("""
    SELECT g.model_id, g.test_file, round(coalesce(avg(c.ppv), 0.0), 6) AS diverse_plate_ppv
    FROM (SELECT DISTINCT model_id, test_file FROM multi_scored) g
    LEFT JOIN (SELECT model_id, test_file, cluster_id, avg(y_true) AS ppv
               FROM (SELECT m.*, a.cluster_id,
                            row_number() OVER (PARTITION BY m.model_id, m.test_file, a.cluster_id
                                               ORDER BY m.y_proba DESC, m.row_id) AS rk
                     FROM multi_scored m JOIN assigned a USING (row_id) WHERE m.y_pred = 1)
               WHERE rk <= 15 GROUP BY model_id, test_file, cluster_id) c
         USING (model_id, test_file)
    GROUP BY g.model_id, g.test_file""", "multi_scored", extra=leaders_sql(LEADER_SIM))
    return _recursive(sql)


@register("diverse_plate_ppv", _diverse_sql())
def q_diverse_plate_ppv(spark, sf):
    clusters = _clusters(spark, sf)
    pred = fx.multi_scored(spark, sf).join(clusters, "row_id")
    return rounded(R.diverse_plate_ppv(pred, ["model_id", "test_file"], "cluster_id", 15))
