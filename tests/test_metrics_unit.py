"""Hand-computed cases for the metric operators (tiny tables, known answers)."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import metrics as M
from screenlake.operators import ranking as R

KEYS = ["g"]


def pred_df(spark, rows):
    """rows: (g, row_id, y_true, y_proba) -> prediction table with y_pred = proba > 0.5."""
    data = [(g, rid, yt, float(p), int(p > 0.5)) for g, rid, yt, p in rows]
    return spark.createDataFrame(data, "g string, row_id string, y_true int, y_proba double, y_pred int")


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def brute_ap(pairs):
    P = sum(y for y, _ in pairs)
    if P == 0:
        return None
    out = 0.0
    for s in sorted({p for _, p in pairs}, reverse=True):
        at = [(y, p) for y, p in pairs if p == s]
        ge = [(y, p) for y, p in pairs if p >= s]
        tp = sum(y for y, _ in ge)
        out += sum(y for y, _ in at) / P * tp / len(ge)
    return out


def test_confusion_and_basic(spark):
    rows = [("a", "1", 1, 0.9), ("a", "2", 1, 0.2), ("a", "3", 0, 0.7), ("a", "4", 0, 0.1), ("a", "5", 0, 0.5)]
    c = M.basic_metrics(M.confusion_counts(pred_df(spark, rows), KEYS)).first()
    assert (c.tp, c.fp, c.tn, c.fn, c.n) == (1, 1, 2, 1, 5)   # 0.5 is not > 0.5 -> class 0
    assert c.accuracy == pytest.approx(3 / 5)
    assert c.precision == pytest.approx(0.5) and c.recall == pytest.approx(0.5)
    assert c.f1 == pytest.approx(0.5)


def test_zero_division_and_agreement(spark):
    rows = [("a", str(i), 0, 0.1) for i in range(4)]          # single class, nothing predicted
    c = M.agreement_metrics(M.basic_metrics(M.confusion_counts(pred_df(spark, rows), KEYS))).first()
    assert c.precision == 0.0 and c.recall == 0.0 and c.f1 == 0.0
    assert c.mcc == 0.0                      # empty margin
    assert c.cohen_kappa is None             # chance agreement 1
    assert c.balanced_accuracy == pytest.approx(1.0)   # only the class present counts


def test_auc_ap_with_ties_match_brute_force(spark):
    rows = [("a", str(i), y, p) for i, (y, p) in enumerate(
        [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (1, 0.2), (0, 0.1), (1, 0.7)])]
    r = M.ranked_metrics(pred_df(spark, rows), KEYS, buckets=4).first()
    pairs = [(y, p) for _, _, y, p in rows]
    assert r.auc_roc == pytest.approx(brute_auc(pairs))
    assert r.average_precision == pytest.approx(brute_ap(pairs))


def test_auc_negated_score_and_single_class(spark):
    rows = [("a", str(i), i % 2, (i * 37 % 11) / 11) for i in range(30)]
    neg = [(g, rid, y, 1 - p) for g, rid, y, p in rows]
    a = M.auc_roc(pred_df(spark, rows), KEYS).first().auc_roc
    b = M.auc_roc(pred_df(spark, neg), KEYS).first().auc_roc
    assert a + b == pytest.approx(1.0)
    one = M.ranked_metrics(pred_df(spark, [("a", "1", 1, 0.3), ("a", "2", 1, 0.6)]), KEYS).first()
    assert one.auc_roc is None and one.average_precision == pytest.approx(1.0)


def test_ap_invariant_under_monotone_rescaling(spark):
    rows = [("a", str(i), int(i % 3 == 0), (i * 13 % 17) / 17) for i in range(40)]
    sq = [(g, rid, y, p ** 3) for g, rid, y, p in rows]
    a = M.average_precision(pred_df(spark, rows), KEYS).first()[1]
    b = M.average_precision(pred_df(spark, sq), KEYS).first()[1]
    assert a == pytest.approx(b)


def test_hits_at_k_caps_k_and_breaks_ties_by_row_id(spark):
    rows = [("a", "1", 1, 0.9), ("a", "2", 0, 0.9), ("a", "3", 1, 0.8), ("a", "4", 1, 0.2)]
    h = R.hits_at_k(pred_df(spark, rows), KEYS, (2, 500)).first()
    assert h.hits_at_2 == 1 and h.precision_at_2 == pytest.approx(0.5)     # rows 1, 2
    assert h.hits_at_500 == 2 and h.precision_at_500 == pytest.approx(2 / 3)


def test_plate_ppv_none_predicted(spark):
    rows = [("a", str(i), 1, 0.2) for i in range(5)]
    assert R.plate_ppv(pred_df(spark, rows), KEYS, 3).first().plate_ppv == 0.0


def test_diverse_plate_ppv(spark):
    rows = [("a", "1", 1, 0.9), ("a", "2", 0, 0.8), ("a", "3", 1, 0.7), ("a", "4", 1, 0.1)]
    df = pred_df(spark, rows)
    clusters = spark.createDataFrame([("1", 0), ("2", 0), ("3", 1), ("4", 2)], "row_id string, cluster_id int")
    out = R.diverse_plate_ppv(df.join(clusters, "row_id"), KEYS, "cluster_id", 15).first()
    # cluster 0: PPV 0.5, cluster 1: 1.0, cluster 2 has no predicted positive (skipped)
    assert out.diverse_plate_ppv == pytest.approx(0.75)


def test_states_add_up_and_fold_means_skip_undefined(spark):
    from screenlake.operators.evaluation import METRIC_COLUMNS, evaluate, fold_means
    rng = np.random.default_rng(5)
    rows = [("m", str(i), int(rng.integers(0, 2)), float(np.round(rng.random(), 1)), i % 3) for i in range(300)]
    rows += [("one", str(i), 1, 0.7, i % 2) for i in range(4)] + [(None, "x", 0, 0.2, 0)]
    df = spark.createDataFrame(rows, "model_id string, row_id string, y_true int, y_proba double, fold int")
    df = df.withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int")).withColumn("cluster_id", F.col("row_id").try_cast("int") % 7)
    whole = {r.model_id: r for r in M.state_metrics(M.evaluation_state(df, ["model_id"]), ["model_id"]).collect()}
    parts = [M.evaluation_state(df.filter(F.col("fold") == f), ["model_id", "fold"]) for f in range(3)]
    merged = {r.model_id: r for r in M.state_metrics(M.merged_state(parts, ["model_id"]), ["model_id"], buckets=5).collect()}
    assert whole == merged and set(whole) == {"m", "one", None}
    assert whole["one"].auc_roc is None and whole["one"].average_precision == 1.0
    per_fold = evaluate(df, ["model_id", "fold"])
    means = {r.model_id: r for r in fold_means(per_fold, ["model_id"]).collect()}
    assert means["m"].n_folds == 3 and means["one"].cv_auc_roc is None
    own = [r for r in per_fold.collect() if r.model_id == "m"]
    for m in METRIC_COLUMNS:
        assert means["m"][f"cv_{m}"] == pytest.approx(sum(r[m] for r in own) / 3)
    # clusters beside the predictions and in a table of their own give the same
    apart = evaluate(df.drop("cluster_id"), ["model_id", "fold"], df.select("model_id", "row_id", "cluster_id").filter("model_id = 'm'"))
    assert {r.fold: r.diverse_plate_ppv for r in apart.collect() if r.model_id == "m"} == {r.fold: r.diverse_plate_ppv for r in own}


def test_top_rows_of_a_hot_group_in_two_levels(spark):
    rng = np.random.default_rng(6)
    rows = [("hot", f"{i:05d}", float(np.round(rng.random(), 2))) for i in range(5000)] + [("cold", "1", 0.5), (None, "2", 0.5)]
    df = spark.createDataFrame(rows, "g string, row_id string, y_proba double").repartition(9)
    top = R.top_k_rows(df, ["g"], 100)
    want = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[2], r[1]))[:100]
    got = sorted((r._rank, r.row_id) for r in top.collect() if r.g == "hot")
    assert got == [(i + 1, r[1]) for i, r in enumerate(want)] and top.count() == 102
    text = top._jdf.queryExecution().toString()
    # a limit before either exchange: one by group and part of it, one by group
    assert text.count("WindowGroupLimit [g#") >= 2 and "_part" in text
