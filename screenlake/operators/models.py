"""Classifier training, scoring, cross-validation and tuning with MLlib.

The capability is "fit many classifiers over a vector column and compare them": every
model reads the same (row_id, features, label) table and produces the same long
prediction table (row_id, y_true, y_proba, y_pred) that the metric operators consume.
"""

from __future__ import annotations

import math
import random
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits
from ..session import cut_lineage
from .metrics import ranked_metrics

SEED = 42
MODELS = ("rf", "lr", "svc", "nb", "dt", "gb", "ada", "bag", "mlp")
# the reference's defaults: trees and rounds of its library's models, draws and folds of its search, folds of its cross-validation
TREES, BAGS, ROUNDS, ADA_ROUNDS, HIDDEN, MLP_ITER, DRAWS, SEARCH_FOLDS, CV_FOLDS = 100, 10, 100, 50, 100, 200, 32, 5, 2

CALIBRATION_FOLDS, SVC_REG = 3, 0.01
FITS = 12               # small fits that run side by side
SLOW_FIRST = ("ada", "gb", "mlp", "rf")
CHECKPOINT_ROUNDS = 4   # of boosting, after which the weights' lineage is cut


def features(df: DataFrame, vec_col: str = "v", label_col: str = "y", key: str = "row_id") -> DataFrame:
    return df.select(key, array_to_vector(vec_col).alias("features"), F.col(label_col).cast("double").alias("label"))


def estimator(name: str, n_features: int = 64, **params):
    """Reference model names -> MLlib estimators (several names share one MLlib model)."""
    name = name.lower()
    own = {k: v for k, v in params.items() if k != "hidden"}
    if name == "rf":
        return RandomForestClassifier(**{"numTrees": TREES, "seed": SEED} | own)
    if name in ("lr", "sgd"):
        return LogisticRegression(**{"maxIter": 50, "regParam": 0.0, "elasticNetParam": 0.0} | own)
    if name == "nb":
        return NaiveBayes(modelType="gaussian")
    if name == "dt":
        return DecisionTreeClassifier(**{"maxDepth": 5, "seed": SEED} | own)
    if name in ("gb", "lgbm", "catboost"):
        return GBTClassifier(**{"maxIter": ROUNDS, "seed": SEED} | own)
    if name == "bag":
        return RandomForestClassifier(**{"numTrees": BAGS, "featureSubsetStrategy": "all", "subsamplingRate": 1.0,
                                         "bootstrap": True, "seed": SEED} | own)
    if name in ("mlp", "tf_ff"):
        hidden = params.get("hidden", HIDDEN)
        layers = [n_features, *(hidden if isinstance(hidden, tuple) else (hidden,)), 2]
        return MultilayerPerceptronClassifier(**{"layers": layers, "maxIter": MLP_ITER, "seed": SEED} | own)
    raise ValueError(f"unknown model {name}")


def _proba(pred: DataFrame, key: str = "row_id") -> DataFrame:
    p = F.get(vector_to_array("probability"), 1)
    return pred.select(key, F.col("label").cast("int").alias("y_true"), p.alias("y_proba")) \
               .withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))


def fit(name: str, train: DataFrame, n_features: int = 64, **params) -> PipelineModel:
    """A fitted model as a pipeline of built-in stages, so that every one can be saved and loaded alike."""
    if name.lower() == "svc":
        return fit_svc(train, **params)
    if name.lower() == "ada":
        return fit_ada(train, **params)
    return PipelineModel([estimator(name, n_features, **params).fit(train)])


def predict(model, test: DataFrame, key: str = "row_id") -> DataFrame:
    return _proba(model.transform(test), key)


def _svc(reg: float) -> LinearSVC:
    return LinearSVC(maxIter=50, regParam=reg, rawPredictionCol="svm_raw", predictionCol="svm_pred")


def _margin() -> VectorSlicer:
    return VectorSlicer(inputCol="svm_raw", outputCol="margin", indices=[1])


def out_of_fold_margins(train: DataFrame, folds: int = CALIBRATION_FOLDS, key: str = "row_id", reg: float = SVC_REG) -> DataFrame:
    """``row, fold, label, margin`` (a vector): each row's margin comes from a machine fitted without its fold."""
    folded = train.withColumn("fold", F.pmod(md5_bits(key), F.lit(folds)).cast("int"))
    parts = []
    for fold in range(folds):
        rest = folded.filter(F.col("fold") != fold)
        # a fold's rest with one class can't be fitted, and tells the calibrator nothing
        if rest.select("label").distinct().count() == 2:
            parts.append(_margin().transform(_svc(reg).fit(rest).transform(folded.filter(F.col("fold") == fold)))
                         .select(F.col(key).alias("row"), "fold", "label", "margin"))
    if not parts:
        raise ValueError("calibration needs both classes outside a fold")
    return reduce(DataFrame.unionByName, parts)


def fit_svc(train: DataFrame, folds: int = CALIBRATION_FOLDS, regParam: float = SVC_REG) -> PipelineModel:
    """Linear SVM has no probability output: a logistic fit of the label on out-of-fold margins (sigmoid / Platt scaling)
    turns the margin of the machine fitted on all rows into one."""
    calibrator = LogisticRegression(featuresCol="margin", maxIter=50).fit(out_of_fold_margins(train, folds, reg=regParam))
    return PipelineModel([_svc(regParam).fit(train), _margin(), calibrator])


def fit_ada(train: DataFrame, rounds: int = ADA_ROUNDS, learning_rate: float = 1.0) -> PipelineModel:
    """Discrete AdaBoost (SAMME, two classes) over depth-1 trees trained with weightCol; ends early once a stump is
    perfect or no better than chance."""
    df = train.select("row_id", "features", "label").withColumn("w", F.lit(1.0))
    stumps, alphas = [], []
    for i in range(rounds):
        names = {"predictionCol": f"_p{i}", "probabilityCol": f"_pr{i}", "rawPredictionCol": f"_r{i}"}
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="w", seed=SEED, **names).fit(df)
        missed = stump.transform(df).withColumn("miss", (F.col(f"_p{i}") != F.col("label")).cast("double"))
        err = missed.agg((F.sum(F.col("w") * F.col("miss")) / F.sum("w")).alias("err")).first()["err"] or 0.0
        if stumps and err >= 0.5:
            break
        alpha = learning_rate * math.log((1 - max(err, 1e-10)) / max(err, 1e-10))
        stumps.append(stump)
        alphas.append(alpha)
        if err <= 1e-10:
            break
        df = missed.select("row_id", "features", "label", (F.col("w") * F.exp(F.lit(alpha) * F.col("miss"))).alias("w"))
        if i % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
            df = cut_lineage(df)
    total = sum(abs(a) for a in alphas) or 1.0
    score = " + ".join(f"{a!r}D * (2 * _p{i} - 1)" for i, a in enumerate(alphas))
    proba = SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-2 * ({score}) / {total!r}D)) AS _yes FROM __THIS__")
    both = SQLTransformer(statement="SELECT *, 1 - _yes AS _no FROM __THIS__")
    return PipelineModel([*stumps, proba, both, VectorAssembler(inputCols=["_no", "_yes"], outputCol="probability")])


# ---- search ----------------------------------------------------------------------------

class Integer:
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high

    def draw(self, rnd: random.Random):
        return rnd.randint(self.low, self.high)


class Uniform(Integer):
    def draw(self, rnd: random.Random):
        return rnd.uniform(self.low, self.high)


class LogUniform(Integer):
    def draw(self, rnd: random.Random):
        return math.exp(rnd.uniform(math.log(self.low), math.log(self.high)))


class Choice:
    def __init__(self, *values):
        self.values = values

    def draw(self, rnd: random.Random):
        return rnd.choice(self.values)


# The reference's search spaces, as far as MLlib has the parameter.  C is 1 / (regParam * rows); a split
# of at least m rows is a leaf of at least m / 2.
SPACES = {
    "rf": {"numTrees": Integer(100, 200), "maxDepth": Integer(5, 15)},
    "lr": {"C": LogUniform(0.01, 10.0)},
    "sgd": {"regParam": LogUniform(1e-5, 1e-2), "elasticNetParam": Choice(0.0, 1.0)},
    "svc": {"C": LogUniform(0.1, 10.0)},
    "dt": {"maxDepth": Integer(3, 10), "split": Integer(2, 10)},
    "gb": {"maxIter": Integer(100, 200), "stepSize": LogUniform(0.01, 0.3), "maxDepth": Integer(3, 7)},
    "ada": {"rounds": Integer(50, 150), "learning_rate": Uniform(0.5, 1.5)},
    "bag": {"numTrees": Integer(10, 50), "subsamplingRate": Uniform(0.5, 1.0)},
    "mlp": {"hidden": Choice((50,), (100,), (100, 50))},
}


def draws(space: dict, n: int = DRAWS, seed: int = SEED) -> list[dict]:
    """Seeded draws of every parameter of a space."""
    rnd = random.Random(seed)
    return [{k: v.draw(rnd) for k, v in space.items()} for _ in range(n)]


def arguments(drawn: dict, rows: int) -> dict:
    """Drawn values as arguments of ``fit`` on ``rows`` rows."""
    out = dict(drawn)
    if "C" in out:
        out["regParam"] = 1.0 / (out.pop("C") * max(rows, 1))
    if "split" in out:
        out["minInstancesPerNode"] = max(1, out.pop("split") // 2)
    return out


def fold_predictions(name: str, folded: DataFrame, folds: int, n_features: int = 64, **params) -> DataFrame:
    """Predictions of every row by a model fitted without its ``fold``, with that column."""
    return reduce(DataFrame.unionByName, [_held_out(name, folded, fold, n_features, params) for fold in range(folds)])


def _held_out(name: str, folded: DataFrame, fold: int, n_features: int, params: dict) -> DataFrame:
    model = fit(name, folded.filter(F.col("fold") != fold), n_features, **params)
    return predict(model, folded.filter(F.col("fold") == fold)).withColumn("fold", F.lit(fold))


def all_fold_predictions(names: tuple[str, ...], folded: DataFrame, folds: int, n_features: int = 64) -> DataFrame:
    """``fold_predictions`` of several models with their ``name``.  A fit is a chain of short jobs that leaves most cores idle,
    so ``FITS`` of them run side by side."""
    todo = [(name, fold) for name in names for fold in range(folds)]
    todo.sort(key=lambda t: SLOW_FIRST.index(t[0]) if t[0] in SLOW_FIRST else len(SLOW_FIRST))

    def one(task: tuple[str, int]) -> DataFrame:
        return _held_out(task[0], folded, task[1], n_features, {}).withColumn("name", F.lit(task[0]))

    with ThreadPool(FITS) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(folded.sparkSession)(one), todo, chunksize=1))


def search(name: str, folded: DataFrame, folds: int = SEARCH_FOLDS, n: int = DRAWS, n_features: int = 64,
           space: dict | None = None, seed: int = SEED) -> list[dict]:
    """Each draw of a model's space with its mean AUC over the folds, best first.  ``folded`` (row_id, features, label, fold) is
    shared by all fits; a model without a space has one draw, its defaults."""
    space = SPACES.get(name.lower(), {}) if space is None else space
    folded = cut_lineage(folded)
    rows = folded.count() * (folds - 1) // folds
    out = []
    for drawn in draws(space, n if space else 1, seed):
        pred = fold_predictions(name, folded, folds, n_features, **arguments(drawn, rows))
        auc = [r["auc_roc"] for r in ranked_metrics(pred, ["fold"]).collect()]      # one row a fold
        there = [a for a in auc if a is not None]
        out.append({"params": drawn, "folds": auc, "cv_auc": sum(there) / len(there) if there else None})
    return sorted(out, key=lambda r: -(r["cv_auc"] or 0.0))


def cross_validate(train_with_fold: DataFrame, est, grid=None, k: int = CV_FOLDS, parallelism: int = FITS):
    """K-fold CV on a precomputed stratified ``fold`` column 0..k-1 (per-fold models kept)."""
    grid = grid or ParamGridBuilder().build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, numFolds=k,
                        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
                        foldCol="fold", parallelism=parallelism, collectSubModels=True)
    return cv.fit(train_with_fold)


def random_search_grid(lr: LogisticRegression, n_iter: int = DRAWS, seed: int = SEED):
    """Seeded random draws: regParam log-uniform in [1e-4, 1], elasticNetParam in {0, 0.5, 1}."""
    rnd = random.Random(seed)
    maps = []
    for _ in range(n_iter):
        maps.append({lr.regParam: 10 ** rnd.uniform(-4, 0), lr.elasticNetParam: rnd.choice([0.0, 0.5, 1.0])})
    return maps


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def pipeline(name: str, n_features: int = 64) -> Pipeline:
    return Pipeline(stages=[estimator(name, n_features)])
