"""Exact k-nearest-neighbour join and vote (Euclidean).

Rows are dealt to the Voronoi cells of pivots, after Lu, Shen, Chen, Ooi (2012):

1. Pivots are ``pivots`` training rows, the first in a hashed order (a bounded number).  Each training row goes to the cell of its
   nearest pivot; a cell keeps its size, its least and largest distance from the pivot, and its k least ones.
2. A query's k-th neighbour is no farther than the k-th least of (distance to a pivot + distance of that cell's row to it): its
   bound.  It is sent to a cell only if the triangle inequality (the cell's ring around its pivot) and the bisecting
   plane between its own pivot and the cell's let a row within the bound lie there.
3. Cells are cut into chunks of training rows and of queries, so that a task compares one bounded chunk with another; it keeps k
   rows a query.  The k best of all chunks are the neighbours.

Ties are broken by the training row's id.  Distances of the rows kept are taken entry by entry, so equal rows are equally far.
Rows with a null vector, or a null or NaN entry, take no part; with fewer than k training rows all are neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PIVOTS = 64
CHUNK = 4096          # training rows, or queries, that meet in one task
SLACK = 1e-9          # relative, for rounding in the bounds


def _vectors(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), v.alias("v"), *more).filter(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to each pivot, taken entry by entry."""
    return np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in pivots], axis=1)


def rough_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by one matrix product; good to about half the digits."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0))


class Cells:
    """Pivots and what the bounds need of their cells; a few numbers for each pivot."""

    def __init__(self, pivots: np.ndarray, stats: dict[int, dict], k: int, chunk: int):
        n = len(pivots)
        self.pivots, self.k = pivots, k
        self.least = np.array([stats[c]["least"] if c in stats else np.inf for c in range(n)])
        self.most = np.array([stats[c]["most"] if c in stats else -np.inf for c in range(n)])
        self.chunks = np.array([-(-stats[c]["n"] // chunk) if c in stats else 0 for c in range(n)])
        near = [(c, d) for c in stats for d in stats[c]["nearest"]]
        self.near_cell = np.array([c for c, _ in near], int)
        self.near_far = np.array([d for _, d in near])
        self.between = to_pivots(pivots, pivots)

    def of(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row and the distance to it."""
        d = to_pivots(v, self.pivots)
        cell = d.argmin(1)
        return cell, d[np.arange(len(v)), cell]

    def reached(self, v: np.ndarray) -> np.ndarray:
        """Whether each query has to be compared with each cell."""
        d = to_pivots(v, self.pivots)
        upper = d[:, self.near_cell] + self.near_far
        k = min(self.k, upper.shape[1])
        # with fewer rows than k all of them are neighbours
        bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if k == self.k else np.full(len(v), np.inf)
        bound = (bound + SLACK * (bound + d.max(1)))[:, None]
        own = d.argmin(1)
        ring = (d - bound <= self.most) & (d + bound >= self.least)
        # a row of cell c is at least this far beyond the plane between the own pivot and c's
        apart = self.between[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d ** 2 - (d[np.arange(len(v)), own] ** 2)[:, None]) / (2 * apart)
        return ring & (np.where(apart > 0, plane, 0) <= bound) & (self.chunks > 0)


def _in_cells(train: DataFrame, pivots: np.ndarray, id_kind: str) -> DataFrame:
    cells = Cells(pivots, {}, 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, far = cells.of(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype("int32")), pa.array(far)],
                                                 ["id", "v", "label", "cell", "far"])
    return train.mapInArrow(run, f"id {id_kind}, v array<double>, label double, cell int, far double")


def _sent(queries: DataFrame, cells: Cells, id_kind: str) -> DataFrame:
    """A row for each query and chunk of a cell it reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, cell = np.nonzero(cells.reached(_matrix(batch.column(1))))
            times = cells.chunks[cell]
            chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            for lo in range(0, len(row), CHUNK):
                part = slice(lo, lo + CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row[part])), batch.column(1).take(pa.array(row[part])),
                     pa.array(cell[part].astype("int32")), pa.array(chunk[part].astype("int32"))], ["id", "v", "cell", "chunk"])
    return queries.mapInArrow(run, f"id {id_kind}, v array<double>, cell int, chunk int")


def _nearest_of_chunk(k: int):
    def run(key, train: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        train = train.sort_values("id", kind="stable", ignore_index=True)
        t, out = np.array(train["v"].tolist()), []
        for q_id, q in zip(queries["id"], queries["v"]):
            q = np.asarray(q)
            d = rough_distances(q[None, :], t)[0] if len(t) else np.zeros(0)
            few = min(k, len(d))
            if not few:
                continue
            # all that could be among the k once distances are exact, ids rising
            close = np.flatnonzero(d <= np.partition(d, few - 1)[few - 1] * (1 + 1e-6) + 1e-7 * (1 + np.abs(q).sum()))
            exact = np.sqrt(((t[close] - q) ** 2).sum(1))
            for i in np.argsort(exact, kind="stable")[:few]:
                out.append((q_id, train["id"].iloc[close[i]], float(exact[i]), train["label"].iloc[close[i]]))
        return pd.DataFrame(out, columns=["query_id", "neighbour_id", "distance", "label"])
    return run


def assignments(queries: DataFrame, train: DataFrame, k: int, pivots: int = PIVOTS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame] | None:
    """Training rows by (cell, chunk), and queries by each (cell, chunk) they have to be compared with."""
    kind = train.schema["id"].dataType.simpleString()
    chosen = train.orderBy(F.xxhash64("id", "v"), "id").select("v").limit(pivots).collect()
    if not chosen:
        return None
    points = np.unique(np.array([r["v"] for r in chosen]), axis=0)
    placed = cut_lineage(_in_cells(train, points, kind))
    size = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("least"), F.max("far").alias("most"))
    top = placed.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("far"))).filter(F.col("place") <= k)
    top = top.groupBy("cell").agg(F.collect_list("far").alias("nearest"))      # k numbers a pivot
    stats = {r["cell"]: r.asDict() for r in size.join(top, "cell").collect()}
    cells = Cells(points, stats, k, chunk)
    counts = F.expr("array(" + ", ".join(map(str, np.maximum(cells.chunks, 1))) + ")")
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.get(counts, F.col("cell"))).cast("int"))
    return dealt.select("id", "v", "label", "cell", "chunk"), _sent(queries, cells, queries.schema["id"].dataType.simpleString())


def knn_join(queries: DataFrame, train: DataFrame, query_id: str, train_id: str, vector_col: str, k: int = 5,
             label_col: str | None = None, pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """``query_id, neighbour_id, distance, label, rank`` (1..k) of every query with a vector; label is null without ``label_col``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    label = (F.col(label_col) if label_col else F.lit(None)).cast("double")
    t = _vectors(train.withColumn("label", label), train_id, vector_col, "label")
    q = _vectors(queries, query_id, vector_col)
    kinds = [df.schema["id"].dataType.simpleString() for df in (q, t)]
    found = f"query_id {kinds[0]}, neighbour_id {kinds[1]}, distance double, label double"
    both = assignments(q, t, k, pivots, chunk)
    if both is None:
        return queries.sparkSession.createDataFrame([], found + ", rank int")
    dealt, sent = both
    # queries of a cell are dealt out too, and its training rows go to each of their shares
    asked = {r["cell"]: -(-r["n"] // chunk) for r in sent.filter("chunk = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = F.get(F.expr("array(" + ", ".join(str(asked.get(c, 0)) for c in range(max(asked, default=0) + 1)) + ")"), F.col("cell"))
    sent = sent.withColumn("share", F.pmod(F.xxhash64("id"), shares).cast("int"))
    dealt = dealt.filter(shares > 0).withColumn("share", F.explode(F.sequence(F.lit(0), (shares - 1).cast("int"))))
    keys = ["cell", "chunk", "share"]
    near = dealt.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(_nearest_of_chunk(k), found)
    order = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn_vote(queries: DataFrame, train: DataFrame, query_id: str, train_id: str, vector_col: str, label_col: str, k: int = 5,
             pivots: int = PIVOTS) -> DataFrame:
    """``query_id, y_proba, y_pred, nearest``: the share of the k neighbours labelled 1, over one half as class, the least distance."""
    votes = knn_join(queries, train, query_id, train_id, vector_col, k, label_col, pivots)
    return votes.groupBy("query_id").agg(F.avg("label").alias("y_proba"), F.min("distance").alias("nearest")).select(
        F.col("query_id").alias(query_id), "y_proba", (F.col("y_proba") > 0.5).cast("int").alias("y_pred"), "nearest")
