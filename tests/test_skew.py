"""Correctness when one group holds most of the rows (the case the two-level designs exist for)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import metrics as M
from screenlake.operators import ranking as R
from screenlake.operators import sampling as S


def _skewed(spark, n_hot=20000, n_cold=50):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("hot", n_hot), ("cold", n_cold)):
        y = rng.integers(0, 2, n)
        p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 3)   # many ties
        rows += [(g, f"{g}{i}", int(y[i]), float(p[i]), int(p[i] > 0.5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, row_id string, y_true int, y_proba double, y_pred int")


def _brute(rows, g):
    y = np.array([r[2] for r in rows if r[0] == g])
    p = np.array([r[3] for r in rows if r[0] == g])
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    ap = 0.0
    for s in np.unique(p):
        ge = p >= s
        ap += (y[p == s].sum() / y.sum()) * (y[ge].sum() / ge.sum())
    return auc, ap


def test_ranked_metrics_under_skew(spark):
    rows, df = _skewed(spark)
    got = {r.g: r for r in M.ranked_metrics(df.repartition(7), ["g"], buckets=16).collect()}
    for g in ("hot", "cold"):
        auc, ap = _brute(rows, g)
        assert got[g].auc_roc == pytest.approx(auc, abs=1e-12)
        assert got[g].average_precision == pytest.approx(ap, abs=1e-12)


def test_topk_under_skew(spark):
    rows, df = _skewed(spark)
    got = {r.g: r for r in R.hits_at_k(df.repartition(7), ["g"], (200,)).collect()}
    hot = sorted([r for r in rows if r[0] == "hot"], key=lambda r: (-r[3], r[1]))[:200]
    assert got["hot"].hits_at_200 == sum(1 for r in hot if r[2] == 1 and r[4] == 1)


def test_exact_sample_under_skew(spark):
    rows, df = _skewed(spark)
    lab = df.select("row_id", F.when(F.col("g") == "hot", 0).otherwise(1).alias("y"))
    out = S.balance(lab, "y", "row_id", [1, 3])
    counts = {(r.ratio, r.y): r["count"] for r in out.groupBy("ratio", "y").count().collect()}
    assert counts == {(1.0, 0): 50, (1.0, 1): 50, (3.0, 0): 150, (3.0, 1): 50}


def test_large_states_are_dealt_over_more_tasks(spark, monkeypatch):
    rows, df = _skewed(spark, n_hot=6000)
    df = df.withColumn("y_proba", F.col("y_proba") + F.length("row_id") / 1000 + F.xxhash64("row_id") % 997 * 1e-7)
    want = {r.g: r for r in M.state_metrics(M.merged_state([M.evaluation_state(df, ["g"])], ["g"]), ["g"]).collect()}
    monkeypatch.setattr(M, "STATE_ROWS", 200)
    parts = M.state_parts(df, ["g"])
    assert 20 < parts < 60 and M.state_parts(df.withColumn("y_proba", F.lit(0.5)), ["g"]) is None
    halves = [M.evaluation_state(df.filter(F.xxhash64("row_id") % 2 == k), ["g"], parts=parts) for k in (0, 1, -1)]
    state = M.merged_state(halves, ["g"], parts)
    sizes = state.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 600
    got = {r.g: r for r in M.state_metrics(state, ["g"], parts).collect()}
    for g in ("hot", "cold"):
        assert all(got[g][c] == pytest.approx(want[g][c]) for c in want[g].asDict() if c != "g")
