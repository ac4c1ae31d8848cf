"""Screening steps: rule flags on a property table, nominees, best row per cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import RULES, rule_columns


def apply_rules(props: DataFrame, key: str, rules=RULES) -> DataFrame:
    return props.select(key, *rule_columns(rules))


def _place(score: str, key: str) -> Column:
    """Rises from the best row on: highest score, then smallest key (of any orderable type); no score comes last."""
    return F.struct(F.col(score).isNull(), -F.col(score), F.col(key))


def best_per_cluster(df: DataFrame, cluster_col: str, score: str, key: str, size: str | None = None) -> DataFrame:
    """Highest ``score`` per cluster (ties: smallest key) with all its columns, and with the number of rows as ``size``; one
    aggregate with a bounded buffer per cluster (min_by), no sort of a cluster's rows."""
    cols = [c for c in df.columns if c != cluster_col]
    counted = [F.count(F.lit(1)).alias(size)] if size else []
    best = df.groupBy(cluster_col).agg(F.min_by(F.struct(*cols), _place(score, key)).alias("_b"), *counted)
    return best.select(cluster_col, *[F.col(f"_b.{c}").alias(c) for c in cols], *([size] if size else []))


def best_per_cluster_first_nonnull(df: DataFrame, cluster_col: str, score: str, key: str) -> DataFrame:
    """Variant matching a 'sort then take first non-null per column' group-by: for each
    column the value of the best-ranked row where that column is not null."""
    cols = [c for c in df.columns if c != cluster_col]
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _place(score, key))).alias(c) for c in cols]
    return df.groupBy(cluster_col).agg(*aggs)
