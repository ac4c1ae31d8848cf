"""The kNN join against brute force; what its cells save."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import knn as KNN


def table(spark, x, first=0, labels=None):
    rows = [(first + i, [float(v) for v in r], None if labels is None else int(labels[i])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, v array<double>, y int")


def brute(q, t, k):
    """Neighbours by (distance, id)."""
    out = {}
    for i, r in enumerate(q):
        d = np.sqrt(((t - r) ** 2).sum(1))
        out[i] = [(int(j), float(d[j])) for j in np.lexsort((np.arange(len(t)), d))[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.neighbour_id, r.distance))
    return out


def clusters(n, seed, width=6):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(0).normal(0, 10, (12, width))
    return centres[rng.integers(0, 12, n)] + rng.normal(0, 0.3, (n, width))


@pytest.mark.parametrize("k, pivots, chunk", [(1, 7, 50), (5, 16, 64), (5, 64, 4096)])
def test_neighbours_equal_brute_force(spark, k, pivots, chunk):
    rng = np.random.default_rng(k + pivots)
    t = np.vstack([clusters(300, 1), rng.normal(0, 5, (60, 6)), np.repeat(clusters(1, 2), 9, axis=0)])
    q = np.vstack([clusters(80, 3), t[:20], rng.normal(0, 30, (10, 6))])
    got = found(KNN.knn_join(table(spark, q).repartition(3), table(spark, t).repartition(5), "row_id", "row_id", "v", k,
                             pivots=pivots, chunk=chunk))
    want = brute(q, t, k)
    assert {i: [j for j, _ in n] for i, n in got.items()} == {i: [j for j, _ in n] for i, n in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-9 for i in want for a, b in zip(got[i], want[i]))


def test_cells_keep_replication_below_all_pairs(spark):
    t, q = clusters(1500, 4), clusters(400, 5)
    vectors = [KNN._vectors(table(spark, x), "row_id", "v", F.lit(None).cast("double").alias("label")) for x in (t, q)]
    dealt, sent = KNN.assignments(vectors[1].drop("label"), vectors[0], 5, pivots=32, chunk=4096)
    size = {(r.cell, r.chunk): r["count"] for r in dealt.groupBy("cell", "chunk").count().collect()}
    compared = sum(size.get((r.cell, r.chunk), 0) * r["count"] for r in sent.groupBy("cell", "chunk").count().collect())
    assert sum(size.values()) == 1500 and compared < 0.25 * 1500 * 400


def test_votes(spark):
    t, q = clusters(200, 6), clusters(40, 7)
    y = (np.arange(200) % 3 == 0).astype(int)
    got = {r.row_id: r for r in KNN.knn_vote(table(spark, q), table(spark, t, labels=y), "row_id", "row_id", "v", "y", 5).collect()}
    for i, near in brute(q, t, 5).items():
        share = np.mean([y[j] for j, _ in near])
        assert got[i].y_proba == pytest.approx(share) and got[i].y_pred == int(share > 0.5)


def test_few_rows_nulls_and_none(spark):
    t = table(spark, [[0.0, 0.0], [0.0, 1.0], [0.0, 1.0]])
    q = table(spark, [[0.0, 0.9]]).unionByName(spark.createDataFrame([(9, None, None), (8, [float("nan"), 0.0], None)], t.schema))
    got = found(KNN.knn_join(q, t, "row_id", "row_id", "v", 5))
    assert {i: [j for j, _ in n] for i, n in got.items()} == {0: [1, 2, 0]}
    assert KNN.knn_join(q, t.limit(0), "row_id", "row_id", "v").collect() == []
    assert KNN.knn_join(q.limit(0), t, "row_id", "row_id", "v").collect() == []
    with pytest.raises(ValueError):
        KNN.knn_join(q, t, "row_id", "row_id", "v", 0)
