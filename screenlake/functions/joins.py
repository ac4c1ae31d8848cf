"""Equi-joins on keys that may be NULL: a NULL group is a group like any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` for inner and left joins, where NULL keys match NULL keys."""
    named = right.select(*[F.col(k).alias(f"_on_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys])
    return left.join(named, on, how).drop(*[f"_on_{k}" for k in keys])
