"""Real fits of every model: saving, calibration on unseen rows, searches over typed spaces."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import models as MD
from screenlake.session import scratch_path

WIDTH = 5
SMALL = {"svc": {"folds": 2}, "rf": {"numTrees": 4}, "gb": {"maxIter": 3}, "ada": {"rounds": 12}, "mlp": {"hidden": (4, 3), "maxIter": 15}}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (160, WIDTH))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.7, 160) > 0).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c), i % 2) for i, (r, c) in enumerate(zip(x, y))],
                               "row_id long, v array<double>, y int, fold int")
    return MD.features(df).join(df.select("row_id", "fold"), "row_id").coalesce(1).cache()


@pytest.mark.parametrize("name", MD.MODELS)
def test_every_model_fits_saves_and_loads(spark, rows, name):
    model = MD.fit(name, rows, WIDTH, **SMALL.get(name, {}))
    loaded = MD.save_and_load(model, scratch_path(spark, f"model-{name}"))
    a, b = ({r.row_id: (r.y_proba, r.y_pred, r.y_true) for r in MD.predict(m, rows).collect()} for m in (model, loaded))
    assert len(a) == 160 and a == b
    assert all(0 <= p <= 1 and c == int(p > 0.5) for p, c, _ in a.values())
    pos = [p for p, _, y in a.values() if y == 1]
    neg = [p for p, _, y in a.values() if y == 0]
    assert np.mean([(p > q) + (p == q) / 2 for p in pos for q in neg]) > 0.7


def test_no_margin_is_scored_by_a_machine_that_saw_its_row(spark, rows, monkeypatch):
    fitted = []
    real = MD._svc

    class Spy:
        def __init__(self, reg):
            self.svc = real(reg)

        def fit(self, train):
            fitted.append({r.row_id for r in train.select("row_id").collect()})
            return self.svc.fit(train)

    monkeypatch.setattr(MD, "_svc", Spy)
    margins = MD.out_of_fold_margins(rows, 2).collect()
    assert sorted(r.row for r in margins) == list(range(160)) and len(fitted) == 2
    for r in margins:
        assert r.row not in fitted[r.fold]
    one = rows.filter("label = 1")
    with pytest.raises(ValueError):
        MD.out_of_fold_margins(one, 3)


def test_boosting_ends_with_a_perfect_stump(spark):
    df = MD.features(spark.createDataFrame([(i, [float(i), 0.0], int(i >= 5)) for i in range(10)], "row_id long, v array<double>, y int"))
    model = MD.fit("ada", df, rounds=9)
    assert len(model.stages) == 4      # one stump, two statements, an assembler
    assert all(r.y_pred == r.y_true for r in MD.predict(model, df).collect())


def test_draws_stay_in_their_spaces():
    for name, space in MD.SPACES.items():
        for drawn in MD.draws(space, 40, 3):
            assert drawn.keys() == space.keys()
            for k, s in space.items():
                assert drawn[k] in s.values if isinstance(s, MD.Choice) else s.low <= drawn[k] <= s.high
                assert isinstance(s, (MD.Choice, MD.Uniform, MD.LogUniform)) or isinstance(drawn[k], int)
    assert MD.draws(MD.SPACES["rf"], 5, 1) == MD.draws(MD.SPACES["rf"], 5, 1) != MD.draws(MD.SPACES["rf"], 5, 2)
    logs = [math.log10(MD.LogUniform(1e-5, 1e-1).draw(random.Random(i))) for i in range(400)]
    assert abs(np.mean(logs) + 3) < 0.2
    assert MD.arguments({"C": 0.5, "maxDepth": 3}, 100) == {"maxDepth": 3, "regParam": 0.02}
    assert MD.arguments({"split": 2}, 9) == {"minInstancesPerNode": 1}


@pytest.mark.parametrize("name, space", [("lr", None), ("sgd", None), ("dt", None), ("nb", None), ("rf", {"numTrees": MD.Integer(2, 4), "maxDepth": MD.Integer(2, 3)}),
                                         ("bag", {"numTrees": MD.Integer(2, 3), "subsamplingRate": MD.Uniform(0.5, 1.0)}),
                                         ("gb", {"maxIter": MD.Integer(2, 3), "stepSize": MD.LogUniform(0.01, 0.3)}),
                                         ("ada", {"rounds": MD.Integer(2, 3), "learning_rate": MD.Uniform(0.5, 1.5)}),
                                         ("mlp", {"hidden": MD.Choice((3,), (3, 2)), "maxIter": MD.Integer(4, 6)})])
def test_search(spark, rows, name, space):
    found = MD.search(name, rows, folds=2, n=2, n_features=WIDTH, space=space)
    assert len(found) == (1 if name == "nb" else 2)
    for r in found:
        assert len(r["folds"]) == 2 and r["cv_auc"] == pytest.approx(sum(r["folds"]) / 2) and 0 <= r["cv_auc"] <= 1
    assert found == sorted(found, key=lambda r: -r["cv_auc"])
