"""Guarded arithmetic (ANSI mode is on in Spark 4: never divide by zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str, default: float | None = 0.0) -> Column:
    num, den = as_col(num), as_col(den)
    fallback = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(den == 0, fallback).otherwise(num.cast("double") / den.cast("double"))


def round6(c: Column | str, name: str | None = None) -> Column:
    out = F.round(as_col(c).cast("double"), 6)
    return out.alias(name) if name else out
