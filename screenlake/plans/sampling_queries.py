"""Sampling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as S
from ..session import scratch_path
from ..sources.files import write_partitioned
from ..sources.tables import read_table
from . import fixtures as fx
from .catalog import register
from .fixture_sql import md5_bits_sql, with_views

SEED = 42
H_SQL = md5_bits_sql(f"'{SEED}|' || row_id")


def _balance_sql(ratios: list[float], select: str) -> str:
    arr = "[" + ", ".join(str(float(r)) for r in ratios) + "]::DOUBLE[]"
    return with_views(f"""
    , cnt AS (SELECT count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM vectors),
    r AS (SELECT unnest({arr}) AS ratio),
    q AS (SELECT ratio, 1 AS y, CASE WHEN ratio = 1 THEN least(pos, neg) ELSE pos END AS quota FROM r, cnt
          UNION ALL
          SELECT ratio, 0 AS y, CASE WHEN ratio = 1 THEN least(pos, neg)
                                     ELSE least(neg, CAST(floor(pos * ratio) AS BIGINT)) END FROM r, cnt),
    rk AS (SELECT r.ratio, v.row_id, v.y,
                  row_number() OVER (PARTITION BY r.ratio, v.y ORDER BY {H_SQL}, v.row_id) AS rn
           FROM vectors v, r WHERE v.y IN (0, 1)),
    bal AS (SELECT ratio, row_id, y FROM rk JOIN q USING (ratio, y) WHERE rn <= quota)
    {select}""", "vectors").replace("\n    , cnt AS", ",\n    cnt AS", 1)


@register("class_counts", with_views("SELECT y, count(*) AS n FROM vectors GROUP BY y", "vectors"))
def q_class_counts(spark, sf):
    return S.class_counts(fx.vectors(spark, sf), "y")


@register("distinct_labels", "SELECT DISTINCT label FROM embeddings")
def q_distinct_labels(spark, sf):
    return read_table(spark, sf, "embeddings", ["label"]).distinct().orderBy("label")


def _balanced(spark, sf, ratios):
    return S.balance(fx.vectors(spark, sf).select("row_id", "y"), "y", "row_id", ratios, SEED)


@register("balance_1x", _balance_sql([1], "SELECT row_id, y FROM bal"))
def q_balance_1x(spark, sf):
    return _balanced(spark, sf, [1]).select("row_id", "y")


@register("balance_rx", _balance_sql([3], "SELECT row_id, y FROM bal"))
def q_balance_rx(spark, sf):
    return _balanced(spark, sf, [3]).select("row_id", "y")


@register("balance_multi", _balance_sql([1, 2, 3], "SELECT ratio, row_id, y FROM bal"))
def q_balance_multi(spark, sf):
    return _balanced(spark, sf, [1, 2, 3]).select("ratio", "row_id", "y")


@register("sink_partitioned_roundtrip", _balance_sql(
    [1, 2, 3], "SELECT ratio, y, count(*) AS n FROM bal GROUP BY ratio, y"))
def q_sink_partitioned_roundtrip(spark, sf):
    # Balanced sets written as one dataset partitioned by ratio, then read back.
    path = scratch_path(spark, "balanced")
    rows = S.shuffled(_balanced(spark, sf, [1, 2, 3]).select("ratio", "row_id", "y"), "row_id", SEED)
    write_partitioned(rows, path, ["ratio"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("ratio").cast("double").alias("ratio"), "y").agg(
        F.count(F.lit(1)).alias("n"))


@register("stratified_folds", with_views(f"""
    SELECT row_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {H_SQL}, row_id) - 1) % 5 AS INTEGER)
           AS fold
    FROM vectors""", "vectors"))
def q_stratified_folds(spark, sf):
    return S.stratified_folds(fx.vectors(spark, sf).select("row_id", "y"), "y", "row_id", 5, SEED)


@register("calibration_split", with_views(f"""
    SELECT row_id, y, CASE WHEN row_number() OVER (ORDER BY {H_SQL}, row_id)
                               <= ceil(count(*) OVER () * 0.3 - 1e-9)
                      THEN 'calibration' ELSE 'proper' END AS split
    FROM vectors""", "vectors"))
def q_calibration_split(spark, sf):
    return S.calibration_split(fx.vectors(spark, sf).select("row_id", "y"), "row_id", 0.3, SEED)
