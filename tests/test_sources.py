"""Sources and sinks round trips, written under the shared folder (never a local temp dir)."""

from pyspark.sql import functions as F

from screenlake.session import scratch_path
from screenlake.sources import files as io


def test_csv_roundtrip_with_schema(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "k bigint, s string, x double")
    path = scratch_path(spark, "t") + ".csv"
    io.write_csv(df, path)
    back = io.read_any(spark, path, "k bigint, s string, x double")
    assert sorted(back.collect()) == sorted(df.collect())


def test_many_files_tagged_by_source(spark):
    base = scratch_path(spark, "many")
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).write.parquet(f"{base}/{name}.parquet")
    back = io.with_source_file(spark.read.parquet(f"{base}/a.parquet", f"{base}/b.parquet"), level="dataset")
    per = {r.source_file: r["count"] for r in back.groupBy("source_file").count().collect()}
    assert per == {"a.parquet": 3, "b.parquet": 5}


def test_load_features_text_and_array(spark):
    df = spark.createDataFrame([(1, "1, 0, 1", [1.0, 0.0], 1), (2, "0,0,1", [0.0, 1.0], 0)],
                               "row_id long, t string, a array<double>, y int")
    out = io.load_features(df, ["t", "a"], "y", nrows=0)
    assert dict(out.dtypes)["t"] == "array<float>" and dict(out.dtypes)["a"] == "array<float>"
    assert out.count() == 2
    assert io.load_features(df, ["t"], "y", nrows=1).count() == 1
