"""Running sums per group without funnelling a whole group through one task.

A plain ``sum(..) over (partition by g order by x)`` sends every row of group ``g`` to one task; a prediction table may
hold a third of its rows in one (model, test file) group.  Instead:

1. rows are range-partitioned by (group, x), so a hot group lies over as many partitions as its share of the rows asks for;
2. totals per (group, partition) form a small table, at most groups + partitions rows; its exclusive running sum is where
   each partition starts, its sum what the group has in all;
3. inside a (group, partition) a window adds the local running sum.

The placed rows are checkpointed: their partition numbers have to stay what the totals were taken for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_null_safe
from ..session import cut_lineage


def running_sums(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                 buckets: int | None = None, prefix: str = "cum_", totals: str | None = None) -> DataFrame:
    """Add ``cum_<v>`` = sum of v over rows of the same keys with order_col <= current, and with ``totals`` as prefix the
    group's sums.  ``order_col`` must be unique within ``keys`` (aggregate ties first).  ``buckets`` ranges, by default as many
    as the session has shuffle partitions."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = buckets or usual
    placed = cut_lineage(df.repartitionByRange(n, *keys, order_col).withColumn("_bucket", F.spark_partition_id()))
    sums = placed.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    group = Window.partitionBy(*keys)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bucket", *[F.coalesce(F.sum(f"_tot_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
                          *([F.sum(f"_tot_{v}").over(group).alias(f"{totals}{v}") for v in value_cols] if totals else []))
    local = Window.partitionBy(*keys, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # more ranges than the session has partitions: as many tasks sort them
    own = placed.repartition(n, *keys, "_bucket") if n > usual else placed
    own = own.select("*", *[F.sum(v).over(local).alias(f"_own_{v}") for v in value_cols])
    out = join_null_safe(own, offsets, keys + ["_bucket"])
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_off_{v}") + F.col(f"_own_{v}"))
    return out.drop("_bucket", *[f"_{k}_{v}" for k in ("off", "own") for v in value_cols])


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based place of each row in a total ``order``: range partitions, their counts (one row per partition), a local
    row number.  The placed rows are checkpointed, as above."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id()))
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return placed.join(offsets, "_bucket").withColumn(name, F.col("_off") + local).drop("_bucket", "_off")
