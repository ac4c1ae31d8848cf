"""Exact-size sampling and splitting (balanced sets, stratified folds, calibration split).

The reference samples exact counts (``sample(n)``), so ``DataFrame.sample`` (approximate
sizes) is not used.  A seeded md5 of the row key gives a reproducible random order; the
position of each row in that order inside its group is computed by ``seeded_rank``
without funnelling a group through one task:

  bucket = top ``bucket_bits`` bits of the hash (uniform, so buckets are balanced);
  per (group, bucket) counts -> running offsets (a small table);
  rank = offset + row_number() inside (group, bucket).

A group holding a third of all rows is thus spread over 2^bucket_bits tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_order
from ..functions.joins import join_null_safe


def seeded_rank(df: DataFrame, group_cols: list[str], key: str, seed: int | str = 42,
                bucket_bits: int = 12, rank_col: str = "_rank") -> DataFrame:
    """1-based rank of each row inside ``group_cols`` by (md5(seed|key), key)."""
    h = seeded_order(seed, key)
    d = df.withColumn("_h", h).withColumn("_b", F.shiftright("_h", 32 - bucket_bits))
    counts = d.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    wl = Window.partitionBy(*group_cols, "_b").orderBy("_h", key)
    ranked = join_null_safe(d, offsets, group_cols + ["_b"]).withColumn(
        rank_col, F.col("_off") + F.row_number().over(wl))
    return ranked.drop("_h", "_b", "_off")


def class_counts(df: DataFrame, label: str, group_cols: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(group_cols or []), label).agg(F.count(F.lit(1)).alias("n"))


def balance_quotas(df: DataFrame, label: str, ratios: list[float]) -> DataFrame:
    """Per (ratio, label) quota.  ratio 1: min(pos, neg) of each class; ratio r > 1: all
    positives and min(neg, int(pos * r)) negatives.  Labels other than 0/1 are dropped."""
    for r in ratios:
        if not (r == 1 or r > 1):
            raise ValueError(f"ratio must be 1 or greater than 1, got {r}")
    counts = (df.filter(F.col(label).isin(0, 1)).groupBy()
              .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    per_ratio = counts.select("pos", "neg", F.explode(F.array(*[F.lit(float(r)) for r in ratios]))
                              .alias("ratio"))
    neg_quota = F.when(F.col("ratio") == 1, F.least("pos", "neg")).otherwise(
        F.least(F.col("neg"), F.floor(F.col("pos") * F.col("ratio")).cast("bigint")))
    pos_quota = F.when(F.col("ratio") == 1, F.least("pos", "neg")).otherwise(F.col("pos"))
    return per_ratio.select("ratio", F.explode(F.array(
        F.struct(F.lit(1).alias(label), pos_quota.alias("quota")),
        F.struct(F.lit(0).alias(label), neg_quota.alias("quota")))).alias("q")).select(
        "ratio", f"q.{label}", "q.quota")


def balance(df: DataFrame, label: str, key: str, ratios: list[float], seed: int = 42) -> DataFrame:
    """Balanced sets for several ratios in one job, tagged by ``ratio``.  Within a ratio each
    class keeps its first ``quota`` rows in the seeded order; sets for smaller quotas are
    nested in those of larger ones.  The quota table has 2 rows per ratio."""
    # the rank doesn't depend on the ratio: rows are ranked once and meet the quotas afterwards
    ranked = seeded_rank(df.filter(F.col(label).isin(0, 1)), [label], key, seed)
    kept = ranked.join(balance_quotas(df, label, ratios), label).filter(F.col("_rank") <= F.col("quota"))
    return kept.drop("_rank", "quota")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """fold = (rank within label in seeded order - 1) mod k: per-label fold sizes differ by <= 1."""
    ranked = seeded_rank(df, [label], key, seed)
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def calibration_split(df: DataFrame, key: str, size: float = 0.3, seed: int = 42) -> DataFrame:
    """Unstratified split: the first ceil(size * n) rows in seeded order are 'calibration'."""
    if not 0 < size < 1:
        raise ValueError("size must be in (0, 1)")
    n = df.groupBy().agg(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
    ranked = seeded_rank(df.withColumn("_all", F.lit(0)), ["_all"], key, seed)
    n_cal = F.ceil(n * F.lit(size) - F.lit(1e-9))
    return ranked.withColumn("split", F.when(F.col("_rank") <= n_cal, "calibration")
                             .otherwise("proper")).drop("_rank", "_all")


def nested_split(df: DataFrame, key: str, test: float = 0.2, calibration: float = 0.3, seed: int = 42) -> DataFrame:
    """``split``: the first ceil(test * n) rows in seeded order are 'test', the next ceil(calibration * rest) 'calibration', what
    remains 'proper'."""
    if not (0 < test < 1 and 0 < calibration < 1):
        raise ValueError("sizes must be in (0, 1)")
    n = df.groupBy().agg(F.count(F.lit(1))).scalar()
    n_test = F.ceil(n * F.lit(test) - F.lit(1e-9))
    n_cal = F.ceil((n - n_test) * F.lit(calibration) - F.lit(1e-9))
    ranked = seeded_rank(df.withColumn("_all", F.lit(0)), ["_all"], key, seed)
    return ranked.withColumn("split", F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_test + n_cal, "calibration")
                             .otherwise("proper")).drop("_rank", "_all")


def shuffled(df: DataFrame, key: str, seed: int | str = 42) -> DataFrame:
    """Seeded random row order inside each output partition (what a 'shuffle before writing'
    needs); a global sort would add a range-partitioning pass for no benefit."""
    return df.sortWithinPartitions(seeded_order(seed, key), key)
