"""Argument validation and the driver contract."""

import pytest
from pyspark.sql import functions as F

from screenlake.operators import vectors as V
from screenlake.sources import files as io


def test_fuse_methods(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0], [4.0])], "row_id int, a array<double>, b array<double>, c array<double>")
    same, names = V.fuse_columns(df, ["a", "b"], None)
    assert names == ["a", "b"]
    out, names = V.fuse_columns(df, ["a", "b", "c"], "ALL")
    assert names == ["a_b_c"] and out.first()["a_b_c"] == [1.0, 2.0, 3.0, 4.0]
    out, names = V.fuse_columns(df, ["a", "b", "c"], "pairwise")
    assert names == ["a_b", "a_c", "b_c"]
    _, names = V.fuse_columns(df, ["a"], "pairwise")
    assert names == []
    with pytest.raises(ValueError):
        V.fuse_columns(df, ["a"], "sideways")


def test_read_validation(spark, tmp_path):
    with pytest.raises(ValueError):
        io.read_parquet_file(spark, "/root/testdata/sf0.001/region.parquet", nrows=-1)
    with pytest.raises(ValueError):
        io.read_any(spark, str(tmp_path / "x.json"))
    df = io.read_parquet_file(spark, "/root/testdata/sf0.001/region.parquet", ["r_regionkey"], 2, ["r_regionkey"])
    assert [r.r_regionkey for r in df.collect()] == [0, 1]


def test_parse_text_vector(spark):
    df = spark.createDataFrame([("1, 0,2.5 , nan",)], "t string")
    got = io.as_float_vector(df, "t").first().t
    assert got[:3] == [1.0, 0.0, 2.5] and got[3] != got[3]   # 'nan' -> NaN


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fingerprint_kinds_ignore_unknown(spark):
    from screenlake.operators import fingerprint as FP
    df = spark.createDataFrame([("a", "the cat sat on the mat"), ("b", "  "), ("c", None)], "id string, text string")
    out = FP.fingerprints(df, "id", "text", ["ngram_r2", "no_such_kind", "key_presence", "ngram_r2"], n_bits=64)
    kinds = {r.kind for r in out.select("kind").distinct().collect()}
    assert kinds == {"ngram_r2", "key_presence"}
    assert {r.id for r in out.select("id").distinct().collect()} == {"a"}   # blank / NULL text: invalid
    n = len("the cat sat on the mat")
    total = out.filter("kind = 'ngram_r2'").agg(F.sum("value")).first()[0]
    assert total == n + (n - 1) + (n - 2)
    dense = FP.dense_fingerprint(out.filter("kind = 'ngram_r2'").drop("kind"), "id", 64)
    assert sum(dense.first().fp) == total and len(dense.first().fp) == 64


def test_shuffled_and_list_text(spark):
    from screenlake.operators import ledger as L
    from screenlake.operators import sampling as S
    df = spark.range(100).withColumnRenamed("id", "k").repartition(3)
    a = [r.k for r in S.shuffled(df, "k", 1).collect()]
    assert sorted(a) == list(range(100)) and a != sorted(a)
    t = spark.range(1).select(L.list_to_text(F.array(F.lit("a"), F.lit("b"))).alias("t")).first().t
    assert t == "a,b"
