"""Connected components of an undirected graph, by contraction.

Every node hooks to its smallest neighbour; the graph of the chosen nodes is built anew without loops and double
edges, and so on until no edge is left.  Node values that behave like random numbers (digests) shrink it by a constant share a round.
Aggregations are partial before they shuffle, so a node with very many neighbours is no single task's work, and joins
against one row per node can be split where they are skewed.  Each round's tables are written to the
shared folder and read again: a checkpoint would keep the planner's estimate of their bytes, a product over the joins that has three times as many
digits after each round and fills the driver's memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b); a label is one of its component's nodes.

    Null ends and loops are ignored; no edges give no row."""
    edges = stored(edges.where("a is not null and b is not null and a != b")
                        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n"))
                           .select("node", F.least("node", "n").alias("to")))
        if labels is None:
            labels = hook.withColumnRenamed("to", "label")
        else:
            labels = stored(labels.join(hook.withColumnRenamed("node", "label").hint("merge"), "label", "left")
                                 .select("node", F.coalesce("to", "label").alias("label")))
        moved = (edges.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ta")).hint("merge"), "a")
                 .join(hook.select(F.col("node").alias("b"), F.col("to").alias("tb")).hint("merge"), "b")
                 .where("ta != tb"))
        edges = stored(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
