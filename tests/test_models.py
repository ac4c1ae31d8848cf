"""Sizes of the training work: those of the reference."""

import inspect
from types import SimpleNamespace

from screenlake.operators import models as MD
from screenlake.plans import catalog, model_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_default_sizes(spark):
    assert MD.estimator("rf").getNumTrees() == 100 and MD.estimator("gb").getMaxIter() == 100
    assert MD.estimator("bag").getNumTrees() == 10  # as the reference's bagging has it
    mlp = MD.estimator("mlp", 7)
    assert list(mlp.getLayers()) == [7, 100, 2] and mlp.getMaxIter() == 200
    assert inspect.signature(MD.fit_ada).parameters["rounds"].default == 50


def test_tuning_draws_32_times_over_5_folds(spark, monkeypatch):
    seen = []

    def cross_validate(feats, est, grid, k):
        seen.append((len(grid), k, sorted(r[0] for r in feats.select("fold").distinct().collect())))
        return SimpleNamespace(avgMetrics=[0.5] * len(grid))

    monkeypatch.setattr(MD, "cross_validate", cross_validate)
    assert catalog.queries()["tune_lr"](spark, SF).count() == 32
    assert seen == [(32, 5, [0, 1, 2, 3, 4])]


def test_every_model_is_cross_validated(spark, monkeypatch):
    real, fitted = MD.fit, []

    def fit(name, train, *a, **k):
        fitted.append(name)
        return real("nb", train)

    monkeypatch.setattr(MD, "fit", fit)
    got = catalog.queries()["cv_models"](spark, SF).collect()
    assert {(r["model_id"], r["test_file"]) for r in got} == {(f"{n}_fold{f}", f"fold{f}") for n in MD.MODELS for f in (0, 1)}
    assert sorted(set(fitted)) == sorted(MD.MODELS)
