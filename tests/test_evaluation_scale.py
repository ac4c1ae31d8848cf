"""What the evaluation reads and ranks: predictions computed once, few rows in a ranking, fits side by side."""

import threading

import pytest
from pyspark.sql import functions as F

from screenlake.operators import models as MD
from screenlake.operators import ranking as R
from screenlake.plans import ledger_queries

SF = "/root/testdata/sf0.001"


def test_full_ledger_reads_its_predictions_from_one_stored_table(spark):
    files = ledger_queries._full_ledger(spark, SF).inputFiles()
    assert files and not any("lineitem" in f for f in files)


@pytest.mark.parametrize("score", ["id % 7", "CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(hash(id) AS DOUBLE) END", "0.5"])
def test_only_rows_up_to_the_bound_are_ranked(spark, score):
    rows = spark.range(20000).select(F.concat(F.lit("r"), "id").alias("row_id"), F.when(F.col("id") % 2 == 0, "g").alias("k"),
                                     F.expr(score).cast("double").alias("y_proba"))
    rows = rows.unionByName(rows.limit(50)).unionByName(rows.limit(3).withColumn("row_id", F.lit(None).cast("string"))).cache()
    order = [F.col("y_proba").desc(), F.col("row_id").asc()]
    near = R._bounded(rows, ["k"], 20, "y_proba", "row_id", order)
    assert near.count() < 8000
    got = sorted(map(str, R.top_k_rows(rows, ["k"], 20).collect()))
    assert got == sorted(map(str, R.top_k_rows(rows, ["k"], 20, spread=1).collect())) and len(got) == 40


def test_fits_of_a_cross_validation_run_side_by_side(spark, monkeypatch):
    df = spark.range(60).select(F.col("id").alias("row_id"), F.array(F.col("id") % 7 * 1.0, F.rand(3)).alias("v"),
                                (F.col("id") % 7 > 3).cast("int").alias("y"), (F.col("id") % 2).cast("int").alias("fold"))
    rows = MD.features(df).join(df.select("row_id", "fold"), "row_id").coalesce(1).cache()
    want = {n: MD.fold_predictions(n, rows, 2, 2).collect() for n in ("nb", "dt")}
    real, meet = MD.fit, threading.Barrier(4, timeout=60)

    def fit(*a, **k):
        meet.wait()      # passes only if all four fits are under way
        return real(*a, **k)

    monkeypatch.setattr(MD, "fit", fit)
    got = MD.all_fold_predictions(("nb", "dt"), rows, 2, 2).collect()
    for name, own in want.items():
        assert sorted((r.row_id, r.y_proba, r.fold) for r in got if r.name == name) == sorted((r.row_id, r.y_proba, r.fold) for r in own)
