"""Property tests: exact sizes, partitions, leader invariants, brute-force equality."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import metrics as M
from screenlake.operators import sampling as S
from screenlake.operators import similarity as SIM
from screenlake.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_balance_exact_sizes_and_subset(spark):
    v = fx.vectors(spark, SF).select("row_id", "y")
    pos = v.filter("y = 1").count()
    neg = v.filter("y = 0").count()
    out = S.balance(v, "y", "row_id", [1, 2], seed=7)
    counts = {(r.ratio, r.y): r["count"] for r in out.groupBy("ratio", "y").count().collect()}
    m = min(pos, neg)
    assert counts[(1.0, 1)] == m and counts[(1.0, 0)] == m
    assert counts[(2.0, 1)] == pos and counts[(2.0, 0)] == min(neg, 2 * pos)
    assert out.join(v, ["row_id", "y"], "left_anti").count() == 0


def test_folds_partition_and_balance(spark):
    v = fx.vectors(spark, SF).select("row_id", "y")
    f = S.stratified_folds(v, "y", "row_id", 5)
    assert f.count() == v.count() and f.select("row_id").distinct().count() == v.count()
    sizes = f.groupBy("y", "fold").count().toPandas()
    for _, g in sizes.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1


def test_seeded_rank_independent_of_partitioning(spark):
    v = fx.vectors(spark, SF).select("row_id", "y")
    a = {r.row_id: r._rank for r in S.seeded_rank(v.repartition(1), ["y"], "row_id").collect()}
    b = {r.row_id: r._rank for r in S.seeded_rank(v.repartition(17), ["y"], "row_id").collect()}
    assert a == b


def _bits(spark):
    rows = fx.vectors(spark, SF).select("row_id", "bits").orderBy("row_id").collect()
    ids = np.array([r.row_id for r in rows])
    bits = np.array([r.bits for r in rows], dtype=np.int64)
    return ids, bits


def _sim_matrix(bits):
    inter = bits @ bits.T
    pop = bits.sum(axis=1)
    union = pop[:, None] + pop[None, :] - inter
    return np.where(union > 0, inter / np.maximum(union, 1), 0.0)


def test_tanimoto_pairs_equal_brute_force(spark):
    ids, bits = _bits(spark)
    sim = _sim_matrix(bits)
    t = 0.5
    want = {(ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1, len(ids)) if sim[i, j] >= t - 1e-9}
    got = {(r.id_l, r.id_r) for r in SIM.tanimoto_pairs(fx.vectors(spark, SF), "row_id", "bits", t).collect()}
    assert got == want


@pytest.mark.parametrize("max_distance", [0.65, 0.5, 0.2])
def test_leaders_equal_sequential_scan(spark, max_distance):
    ids, bits = _bits(spark)
    sim = _sim_matrix(bits)
    s = 1 - max_distance
    leaders = []
    for i in range(len(ids)):
        if not any(sim[i, j] >= s - 1e-9 for j in leaders):
            leaders.append(i)
    got = SIM.leader_pick(fx.vectors(spark, SF), "row_id", "bits", max_distance)
    got_ids = [r.row_id for r in got.orderBy("cluster_id").collect()]
    assert got_ids == [int(ids[i]) for i in leaders]
    # every row is within the threshold of its assigned leader; leaders are not near each other
    assign = SIM.assign_to_leaders(fx.vectors(spark, SF), "row_id", "bits", got, max_distance)
    assert assign.count() == len(ids)
    assert assign.filter(F.col("similarity") < s - 1e-9).count() == 0


def test_auc_same_under_repartition(spark):
    s = fx.scored(spark, SF)
    a = sorted(M.auc_roc(s.repartition(1), ["model_id", "test_file"]).collect())
    b = sorted(M.auc_roc(s.repartition(13), ["model_id", "test_file"]).collect())
    assert [round(x.auc_roc, 12) for x in a] == [round(x.auc_roc, 12) for x in b]


def test_conformal_set_size_grows_with_confidence(spark):
    from screenlake.operators import conformal as C
    ms = fx.multi_scored(spark, SF)
    split = S.calibration_split(fx.vectors(spark, SF).select("row_id"), "row_id", 0.3)
    j = ms.join(split, "row_id")
    cal = j.filter(F.col("split") == "calibration")
    sizes = []
    for conf in (0.5, 0.8, 0.95):
        q = C.conformal_threshold(cal, ["model_id"], conf)
        cov = C.coverage(C.prediction_sets(j.filter(F.col("split") == "proper"), q, ["model_id"]), ["model_id"])
        sizes.append({r.model_id: r.mean_set_size for r in cov.collect()})
    for m in sizes[0]:
        assert sizes[0][m] <= sizes[1][m] <= sizes[2][m]


def test_leaders_with_text_ids_and_null_vectors(spark):
    rows = [(f"id{i:03d}", [1, 1, 0, 0] if i % 3 else [0, 0, 1, 1]) for i in range(40)] + [("a", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, bits array<int>").repartition(5)
    got = [(r.row_id, r.cluster_id) for r in SIM.leader_pick(df, "k", "bits", 0.5).orderBy("cluster_id").collect()]
    assert got == [("id000", 0), ("id001", 1)]
    assert SIM.assign_to_leaders(df, "k", "bits", SIM.leader_pick(df, "k", "bits", 0.5), 0.5).count() == 40


def test_threshold_zero_is_refused(spark):
    df = spark.createDataFrame([(1, [1, 0])], "k long, bits array<int>")
    with pytest.raises(ValueError):
        SIM.leader_pick(df, "k", "bits", 1.0)
    with pytest.raises(ValueError):
        SIM.tanimoto_pairs(df, "k", "bits", 0.0)


def test_null_groups_and_labels_keep_their_rows(spark):
    rows = [(i, None if i % 10 == 0 else i % 2) for i in range(100)]
    folds = S.stratified_folds(spark.createDataFrame(rows, "k long, y int"), "y", "k", 5)
    assert folds.count() == 100 and folds.filter("y is null").count() == 10
    preds = [(m, f, i, i % 2, int(i % 3 == 0), (i * 7 % 10) / 10) for m in (1, None) for f in ("a", None) for i in range(20)]
    df = spark.createDataFrame(preds, "model_id int, test_file string, row_id long, y_true int, y_pred int, y_proba double")
    from screenlake.operators.evaluation import evaluate
    keys = ["model_id", "test_file"]
    assert M.auc_roc(df, keys).count() == 4 and evaluate(df, keys).count() == 4
