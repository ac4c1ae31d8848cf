"""Table access and small shared pieces of the llm operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def whole_rows(df: DataFrame) -> DataFrame:
    """Each row as one struct ``row``, so that columns added beside it can't clash with the table's own."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
