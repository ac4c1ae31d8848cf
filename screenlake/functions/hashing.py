"""Deterministic hashing shared by fixtures, sampling and fingerprints.

Hash = first 8 hex digits of md5, read as an unsigned 32-bit integer.  The same
value is produced in SQL engines by ``('0x' || substr(md5(x), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def md5_bits(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_unit(c: Column | str) -> Column:
    """Uniform-looking value in [0, 1) derived from md5 of the text form of ``c``."""
    return md5_bits(c).cast("double") / F.lit(TWO_POW_32)


def seeded_order(seed: int | str, key: Column | str) -> Column:
    """Sort key that reproduces a seeded random permutation: md5(seed || '|' || key)."""
    key = F.col(key) if isinstance(key, str) else key
    return md5_bits(F.concat(F.lit(f"{seed}|"), key.cast("string")))
