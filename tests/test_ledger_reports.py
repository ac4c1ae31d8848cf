"""Ranking and reporting of the ledger; conformal sets from scorers refitted on the proper part."""

import math

import pytest
from pyspark.sql import functions as F

from screenlake.operators import ledger as L
from screenlake.operators import sampling as S
from screenlake.plans import catalog
from screenlake.session import scratch_path

SF = "/root/testdata/sf0.001"


def rows(spark, columns, n=60):
    data = [(f"m{i % 20}", f"t{i % 3}", "d", f"{i:03d}", *[None if (i + j) % 11 == 0 else float((i * (j + 3)) % 7) for j in range(len(columns))])
            for i in range(n)]
    return spark.createDataFrame(data, "model_path string, test_file_name string, run_date string, run_time string, "
                                 + ", ".join(f"{c} double" for c in columns))


def by_hand(df, columns):
    key = lambda r: (*[(r[c] is None, -(r[c] or 0.0)) for c in columns], r.model_path, r.test_file_name, r.run_date, r.run_time)
    return [r.run_time for r in sorted(df.collect(), key=key)]


def test_ranks_by_the_configured_columns_and_their_fallback(spark):
    for columns in (L.EVAL_COLUMNS, L.CV_COLUMNS, ["test_accuracy"]):
        df = rows(spark, columns).repartition(7)
        used = columns if len(columns) > 1 else []
        assert L.sort_columns(df) == used
        ranked = L.rank_ledger(df)
        got = [r.run_time for r in sorted(ranked.collect(), key=lambda r: r["rank"])]
        assert got == by_hand(df, used) and sorted(r["rank"] for r in ranked.collect()) == list(range(1, 61))
    df = rows(spark, [*L.EVAL_COLUMNS, *L.CV_COLUMNS])
    assert L.sort_columns(df) == L.EVAL_COLUMNS
    assert [r.run_time for r in sorted(L.rank_ledger(df, ["cv_recall"]).collect(), key=lambda r: r["rank"])] == by_hand(df, ["cv_recall"])
    best = {r.model_path: r.run_time for r in L.best_per_model(df).collect()}
    order = by_hand(df, L.EVAL_COLUMNS)
    assert all(t == next(x for x in order if int(x) % 20 == int(m[1:])) for m, t in best.items()) and len(best) == 20
    assert [r.run_time for r in L.select_top(df, 3).collect()] == [t for t in order if t in best.values()][:3]


def test_means_grid_and_radar(spark):
    df = rows(spark, [*L.PLOTTED, *L.RADAR]).withColumn("model_type", F.substring("model_path", 1, 2)).withColumn(
        "column_name", F.when(F.col("model_type") == "m1", "A").otherwise(F.col("test_file_name")))
    grid = {(r.model_type, r.column_name): r for r in L.metric_grid(df).collect()}
    kinds, names = ({r[c] for r in df.collect()} for c in ("model_type", "column_name"))
    assert set(grid) == {(m, c) for m in kinds for c in names}
    assert all(grid["m2", "A"][m] == 0.0 for m in L.PLOTTED)
    own = [r[L.PLOTTED[0]] for r in df.collect() if r.model_type == "m1" and r[L.PLOTTED[0]] is not None]
    assert math.isclose(grid["m1", "A"][L.PLOTTED[0]], sum(own) / len(own))
    assert L.radar_profile(df).columns == L.RADAR and L.radar_profile(df).count() == 1
    assert L.radar_profile(df.drop(L.RADAR[-1])).count() == 0


def test_names_of_fused_columns_stay_whole(spark):
    df = spark.createDataFrame([("rf_ECFP4_model",), ("svc_ECFP4_MACCS_model",), ("lr",)], "model_path string")
    got = {r.model_path: (r.model_key, r.column_key) for r in L.model_keys(df).collect()}
    assert got == {"rf_ECFP4_model": ("rf_ECFP4", "ECFP4"), "svc_ECFP4_MACCS_model": ("svc_ECFP4_MACCS", "ECFP4_MACCS"), "lr": ("lr", "lr")}


def test_nested_split_and_coverage(spark):
    split = S.nested_split(spark.range(200).withColumnRenamed("id", "k"), "k", 0.2, 0.3)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"test": 40, "calibration": 48, "proper": 112}
    got = catalog.queries()["conformal_coverage"](spark, SF).collect()
    n_test = 100     # of 500 vectors
    for r in got:
        assert r.coverage >= 0.95 - 3 * math.sqrt(0.95 * 0.05 / n_test) and 0 <= r.mean_set_size <= 2


def as_rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def test_versions_unions_and_upserts(spark):
    path = scratch_path(spark, "ledger-test")
    assert L.manifest(spark, path) is None
    with pytest.raises(ValueError):
        L.read_ledger(spark, path)
    one = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None), (None, 3, 0.1)], "model string, depth int, cv double")
    two = spark.createDataFrame([("c", "x")], "model string, fused string")
    assert L.append_to_path(one, path) == 1 and L.append_to_path(two, path) == 2
    got = L.read_ledger(spark, path)
    assert got.columns == ["model", "depth", "cv", "fused"] and got.count() == 4
    assert {r.model: (r.depth, r.cv, r.fused) for r in got.collect()} == {"a": (1, 0.5, None), "b": (2, None, None), None: (3, 0.1, None), "c": (None, None, "x")}
    assert as_rows(L.read_ledger(spark, path, 1)) == as_rows(one)
    new = spark.createDataFrame([("a", 0.9, 0.7), (None, None, 0.2), ("z", 0.3, 0.4)], "model string, cv double, test double")
    assert L.upsert(spark, path, new, ["model"]) == 3
    assert {r.model: (r.depth, r.cv, r.fused, r.test) for r in L.read_ledger(spark, path).collect()} == {
        "a": (1, 0.9, None, 0.7), "b": (2, None, None, None), None: (3, None, None, 0.2), "c": (None, None, "x", None), "z": (None, 0.3, None, 0.4)}
    assert L.read_ledger(spark, path, 2).count() == 4
    with pytest.raises(ValueError):
        L.append_to_path(spark.createDataFrame([("d", "deep")], "model string, depth string"), path)


def test_an_interrupted_append_leaves_the_former_version(spark, monkeypatch):
    path = scratch_path(spark, "ledger-test")
    L.append_to_path(spark.createDataFrame([("a", 1)], "model string, depth int"), path)
    real = L.json.dumps
    monkeypatch.setattr(L.json, "dumps", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):       # data are there, the manifest isn't
        L.append_to_path(spark.createDataFrame([("b", 2)], "model string, depth int"), path)
    monkeypatch.setattr(L.json, "dumps", real)
    assert [r.model for r in L.read_ledger(spark, path).collect()] == ["a"]
    # a writer that has read the same version as another comes second
    before = L.manifest(spark, path)
    late = spark.createDataFrame([("c", 3)], "model string, depth int")
    L.append_to_path(late, path)
    with pytest.raises(Exception, match="(?i)exist"):
        L._write_version(late, path, before, keep=True)
    assert sorted(r.model for r in L.read_ledger(spark, path).collect()) == ["a", "c"]
