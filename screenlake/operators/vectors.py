"""Vector-column operators: fusion (all / pairwise / none), long expansion, packing."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import binarize, pack_bits, popcount

FUSION_METHODS = ("none", "all", "pairwise")


def fuse_columns(df: DataFrame, columns: list[str], method: str | None = None) -> tuple[DataFrame, list[str]]:
    """Concatenate vector columns.  'all' -> one column named 'c1_c2_..' in listed order;
    'pairwise' -> one column per unordered pair (i < j) named 'ci_cj' (one column -> none);
    'none' / None -> unchanged.  Case-insensitive; anything else raises ValueError."""
    m = "none" if method is None else str(method).lower()
    if m not in FUSION_METHODS:
        raise ValueError(f"unknown fusion method {method!r}; expected one of {FUSION_METHODS}")
    if m == "none":
        return df, list(columns)
    if m == "all":
        name = "_".join(columns)
        return df.withColumn(name, F.concat(*[F.col(c) for c in columns])), [name]
    names = []
    for a, b in combinations(columns, 2):
        name = f"{a}_{b}"
        df = df.withColumn(name, F.concat(F.col(a), F.col(b)))
        names.append(name)
    return df, names


def expand_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """Vector -> long rows (key, feature 'column_i', value); a narrow, map-only explode."""
    ex = df.select(key, F.posexplode(column).alias("pos", "value"))
    return ex.select(key, F.concat(F.lit(f"{column}_"), F.col("pos").cast("string")).alias("feature"),
                     F.col("pos").cast("bigint").alias("pos"), "value")


def binarize_pack(df: DataFrame, column: str, out: str = "packed") -> DataFrame:
    """Counts/floats -> presence bits -> array<bigint> words, plus the popcount."""
    packed = pack_bits(binarize(column))
    return df.withColumn(out, packed).withColumn(f"{out}_popcount", popcount(out))
