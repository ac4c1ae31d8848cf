"""File sources and sinks: projected/limited parquet scans, feature+label scans,
CSV-or-parquet dispatch, many-file reads with a source tag, partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import parse_text_vector


def _check_nrows(nrows) -> None:
    if nrows is not None and (not isinstance(nrows, int) or isinstance(nrows, bool) or nrows < 0):
        raise ValueError("nrows: expected None or a whole number from 0 up")


def read_parquet_file(spark: SparkSession, path: str, columns: list[str] | None = None,
                      nrows: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Projection pushed into the scan; ``nrows`` keeps the first n rows by ``order_by``
    (a total order; file order is not stable under parallel reads)."""
    _check_nrows(nrows)
    df = spark.read.parquet(path)
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in file: {missing}")
        df = df.select(*columns)
    if nrows is not None:
        df = (df.orderBy(*order_by) if order_by else df).limit(nrows)
    return df


def as_float_vector(df: DataFrame, column: str) -> DataFrame:
    """Vector column as array<float>, whether stored as text ('0, 1, ...') or as an array.
    The type is taken from the schema, never sniffed from a row."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return df.withColumn(column, parse_text_vector(column))
    if isinstance(dtype, T.ArrayType):
        return df.withColumn(column, F.col(column).cast("array<float>"))
    raise ValueError(f"column {column} is neither text nor array: {dtype.simpleString()}")


def load_features(df: DataFrame, columns: list[str], label: str, key: str = "row_id",
                  nrows: int | None = None) -> DataFrame:
    """One projection (key, vector columns parsed to array<float>, label).
    ``nrows`` <= 0 or not an int -> all rows; more than available -> all rows."""
    for c in columns + [label, key]:
        if c not in df.columns:
            raise ValueError(f"column {c} not found")
    out = df.select(key, *columns, label)
    for c in columns:
        out = as_float_vector(out, c)
    if isinstance(nrows, int) and not isinstance(nrows, bool) and nrows > 0:
        out = out.orderBy(key).limit(nrows)
    return out


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Dispatch on suffix: .csv (header; explicit schema when given) or .parquet."""
    lower = path.rstrip("/").lower()
    if lower.endswith(".csv"):
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file type: {path}")


def with_source_file(df: DataFrame, column: str = "source_file", level: str = "file") -> DataFrame:
    """Tag rows with where they came from (hidden _metadata column): the file name, or with
    ``level='dataset'`` the directory holding it (a Spark-written dataset is a directory of
    part files)."""
    if level == "file":
        return df.withColumn(column, F.col("_metadata.file_name"))
    if level == "dataset":
        return df.withColumn(column, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    raise ValueError("level must be 'file' or 'dataset'")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
