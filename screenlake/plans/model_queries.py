"""Model queries (E1, T1-T13; T4 also as pure SQL with an oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import md5_bits
from ..operators import knn as KNN
from ..operators import models as MD
from ..operators import sampling as S
from ..operators.evaluation import evaluate, fold_means
from ..session import cut_lineage, scratch_path
from . import fixtures as fx
from .catalog import register
from .fixture_sql import md5_bits_sql, with_views
from .metric_queries import rounded

SEED = 42


def _split(spark, sf, folds: int = MD.CV_FOLDS):
    """Stratified split of the vectors; of 2 folds, fold 1 trains and fold 0 tests."""
    v = fx.vectors(spark, sf)
    folded = S.stratified_folds(v.select("row_id", "v", "y"), "y", "row_id", folds, SEED)
    feats = MD.features(folded.select("row_id", "v", "y")).join(folded.select("row_id", "fold"), "row_id")
    return feats


def _train_eval(name: str, **params):
    def q(spark, sf):
        feats = _split(spark, sf)
        train, test = feats.filter("fold = 1"), feats.filter("fold = 0")
        model = MD.fit(name, train, **params)
        pred = MD.predict(model, test).withColumn("model_id", F.lit(name)) \
                 .withColumn("test_file", F.lit("fold0"))
        return rounded(evaluate(pred, ["model_id", "test_file"], materialize=True))
    return q


for _name in MD.MODELS:
    register("train_gbt" if _name == "gb" else f"train_{_name}")(_train_eval(_name))


@register("score_model")
def q_score_model(spark, sf):
    feats = _split(spark, sf)
    model = MD.fit("lr", feats.filter("fold = 1"))
    return MD.predict(model, feats)


NEIGHBOURS = 5   # the reference's library default


@register("knn_vote", with_views(f"""
    SELECT row_id, avg(CAST(y AS DOUBLE)) AS y_proba, CAST(avg(CAST(y AS DOUBLE)) > 0.5 AS INTEGER) AS y_pred, round(min(d), 6) AS nearest
    FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, near_id) AS k
          FROM (SELECT q.row_id, t.row_id AS near_id, t.y, list_distance(CAST(q.v AS DOUBLE[]), CAST(t.v AS DOUBLE[])) AS d
                FROM vectors q, vectors t
                WHERE {md5_bits_sql('q.row_id')} % 2 = 0 AND {md5_bits_sql('t.row_id')} % 2 = 1))
    WHERE k <= {NEIGHBOURS} GROUP BY row_id""", "vectors"))
def q_knn_vote(spark, sf):
    v = fx.vectors(spark, sf).withColumn("side", F.pmod(md5_bits("row_id"), F.lit(2)))
    out = KNN.knn_vote(v.filter("side = 0"), v.filter("side = 1"), "row_id", "row_id", "v", "y", NEIGHBOURS)
    return out.withColumn("nearest", F.round("nearest", 6))


@register("cv_models")
def q_cv_models(spark, sf):
    """A row per model and fold: its metrics on the held-out fold, and beside them the model's means over the folds (``cv_``)."""
    feats = cut_lineage(_split(spark, sf))   # one fold table shared by all fits
    preds = MD.all_fold_predictions(MD.MODELS, feats, MD.CV_FOLDS)
    per_fold = cut_lineage(evaluate(preds, ["name", "fold"], materialize=True))
    both = per_fold.join(fold_means(per_fold, ["name"]), "name")
    fold = F.concat(F.lit("fold"), F.col("fold").cast("string"))
    return rounded(both.select(F.concat("name", F.lit("_"), fold).alias("model_id"), fold.alias("test_file"),
                               *[c for c in both.columns if c not in ("name", "fold")]))


@register("tune_lr")
def q_tune_lr(spark, sf):
    feats = cut_lineage(_split(spark, sf, MD.SEARCH_FOLDS))
    lr = MD.estimator("lr")
    grid = MD.random_search_grid(lr)
    cv = MD.cross_validate(feats, lr, grid, MD.SEARCH_FOLDS)
    rows = [(float(m[lr.regParam]), float(m[lr.elasticNetParam]), float(a))
            for m, a in zip(grid, cv.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, cv_auc double")


@register("model_roundtrip", with_views("SELECT row_id, true AS identical FROM vectors", "vectors"))
def q_model_roundtrip(spark, sf):
    feats = _split(spark, sf)
    model = MD.fit("lr", feats.filter("fold = 1"))
    loaded = MD.save_and_load(model, scratch_path(spark, "model_lr"))
    a = MD.predict(model, feats).select("row_id", F.col("y_proba").alias("p_fit"))
    b = MD.predict(loaded, feats).select("row_id", F.col("y_proba").alias("p_loaded"))
    return a.join(b, "row_id").select("row_id", (F.abs(F.col("p_fit") - F.col("p_loaded")) < 1e-12)
                                      .alias("identical"))


@register("gaussian_nb_sql", with_views(
    "SELECT row_id, y_true, y_proba, y_pred FROM multi_scored WHERE model_id = 'gnb'", "multi_scored"))
def q_gaussian_nb_sql(spark, sf):
    # Gaussian NB as plain aggregates (per class/dimension mean and variance) + a map-only score
    return fx.multi_scored(spark, sf).filter(F.col("model_id") == "gnb").select(
        "row_id", "y_true", "y_proba", "y_pred")
