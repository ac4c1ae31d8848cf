"""Whitening of embeddings by an incremental eigendecomposition.

1. Each partition keeps count, mean and spectrum of its scatter matrix.  A vector is one centred rank-one update: its
   difference from the mean in the eigenbasis gives a secular equation; components it doesn't touch and equal eigenvalues
   are deflated, the other roots are found between their poles, and eigenvectors come from the Loewner form, which keeps
   them orthogonal (Bunch, Nielsen, Sorensen 1978; Gu, Eisenstat 1994).  A vector repeated in a batch is one weighted update.
2. Spectra are combined by successive rank-one updates, ``FAN`` at a time in a tree of tasks: each eigenpair of one is added
   to the other, then the difference of their means.
3. Rayleigh-Ritz refinement: all rows, centred exactly, are projected on the basis; the projected covariance is summed over the
   partitions, and its small eigenproblem turns the basis into eigenvectors to double precision.

Entries are whole numbers x = floor(1024 c) + 100000, so counts, sums and deviations are exact, and n x - S centres
without rounding.  The driver holds matrices of the vectors' width alone.

Defined cases: a row whose vector is null or holds a null or non-finite entry is dropped; a shorter vector counts as if its
missing entries were 0; |x| is held to 2^52; rows with equal or null ids are whitened separately; a component without
variance has a null ``whitened`` and takes no part in ``identity_error``; an empty table, or empty vectors alone, give no row; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.session import cut_lineage

SCALE, SHIFT, MOST = 1024.0, 100_000, 1 << 52
COMPONENTS, FAN = 8, 16
EPS = float(np.finfo("float64").eps)
EXACT = pa.decimal128(38, 0)
SPECTRA = "part long, n long, sums array<decimal(38,0)>, mean array<double>, eigenvalues array<double>, basis array<double>"
RESULT = "vec_id long, component int, deviation decimal(38,0), whitened double"


# ---- one spectrum ----------------------------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``delta[j, i] = d[i] - root[j]`` for the roots of 1 + sum(z2 / (d - x)) = 0; d rises strictly, z2 > 0.

    Every root is sought from the nearer of its two poles, so that the differences keep their relative accuracy."""
    k = len(d)
    j = np.arange(k)
    gap = np.append(np.diff(d), z2.sum())
    above = np.minimum(j + 1, k - 1)
    at_mid = 1 + (z2 / ((d - d[:, None]) - gap[:, None] / 2)).sum(1)
    right = (at_mid < 0) & (j < k - 1)
    origin = np.where(right, above, j)
    shifted = d - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(j < k - 1, gap / 2, gap))
    mu = (low + high) / 2
    left_poles = (j[None, :] <= j[:, None]).astype("float64")
    last, ones = j == k - 1, np.ones(k)
    for _ in range(60):
        delta = shifted - mu[:, None]
        inverse = 1 / delta
        term = z2 * inverse
        slope = term * inverse
        psi, dpsi = (term * left_poles) @ ones, (slope * left_poles) @ ones
        phi, dphi = term @ ones - psi, slope @ ones - dpsi
        f = 1 + psi + phi
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        d1, d2 = delta[j, j], delta[j, above]
        c = 1 + (psi - d1 * dpsi) + np.where(last, 0, phi - d2 * dphi)
        a = c * (d1 + d2) + d1 * d1 * dpsi + d2 * d2 * dphi
        b = d1 * d2 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, d1 + d1 * d1 * dpsi / c, step)
        new = mu + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        settled = (np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi))) | (np.abs(new - mu) <= 2 * EPS * np.abs(mu))
        mu = np.where(settled, mu, new)
        if settled.all():
            break
    return shifted - mu[:, None]


class Spectrum:
    """Count, mean and eigenpairs (rising) of the scatter matrix of vectors."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, basis: np.ndarray):
        self.n, self.mean, self.values, self.basis = n, mean, values, basis

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def rank_one(self, rho: float, v: np.ndarray) -> None:
        """The scatter grows by rho v v^T."""
        z = v @ self.basis
        size = float(z @ z)
        if not rho * size > 0:
            return
        rho, z, d = rho * size, z / math.sqrt(size), self.values
        tiny = 8 * EPS * max(float(d[-1]), rho)
        close = np.flatnonzero(np.diff(d) <= tiny)
        if len(close):
            z = self._turn_equal(z, tiny)
        live = np.flatnonzero(rho * np.abs(z) > tiny)
        if len(live) == 1:
            d[live] += rho * z[live] ** 2
        elif len(live):
            dl, zl = d[live], z[live]
            delta = secular_roots(dl, rho * zl * zl)
            between = dl[:, None] - dl[None, :]          # [j, i] = d_j - d_i
            np.fill_diagonal(between, 1.0)
            zl = np.copysign(np.sqrt(np.abs(np.prod(-delta / between, axis=0))), zl)
            u = zl / delta
            u /= np.sqrt((u * u).sum(1))[:, None]
            d[live] = dl - np.diagonal(delta)
            self.basis[:, live] = self.basis[:, live] @ u.T
        order = np.argsort(d, kind="stable")
        if (order[1:] < order[:-1]).any():
            self.values, self.basis = d[order], self.basis[:, order]

    def _turn_equal(self, z: np.ndarray, tiny: float) -> np.ndarray:
        """Turns the basis of every run of equal eigenvalues so that z touches its last vector alone."""
        d, z, at = self.values, z.copy(), 0
        while at < len(d):
            end = int(np.searchsorted(d, d[at] + tiny, "right"))
            if end - at > 1:
                w = z[at:end].copy()
                norm = float(np.sqrt(w @ w))
                if norm > 0:
                    sign = math.copysign(1.0, w[-1])
                    w[-1] += sign * norm
                    part = self.basis[:, at:end]
                    self.basis[:, at:end] = part - np.outer(part @ w, w * (2 / (w @ w)))
                    z[at:end] = 0
                    z[end - 1] = -sign * norm
            at = max(end, at + 1)
        return z

    def add(self, x: np.ndarray, weight: int) -> None:
        """A vector that occurs ``weight`` times."""
        total, delta = self.n + weight, x - self.mean
        self.rank_one(self.n * weight / total, delta)
        self.mean = self.mean + delta * (weight / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        total, delta = self.n + other.n, other.mean - self.mean
        for value, v in zip(other.values, other.basis.T):
            if value > 0:
                self.rank_one(float(value), v)
        self.rank_one(self.n * other.n / total, delta)
        self.mean = self.mean + delta * (other.n / total)
        self.n = total


# ---- rows ------------------------------------------------------------------------------

def whole_entries(column: pa.Array, width: int) -> np.ndarray:
    """x of a batch of lists, int64; entries missing at the end stand for 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    c = np.zeros((len(column), width))
    c[np.arange(width)[None, :] < sizes[:, None]] = flat
    return np.clip(np.floor(SCALE * c) + SHIFT, -MOST, MOST).astype("int64")


def _wide(x: np.ndarray, times: int) -> np.ndarray:
    """The same whole numbers, as Python's where 64 bits could overflow once multiplied by ``times``."""
    most = int(np.abs(x).max(initial=0))
    return x if most * max(1, times) < 1 << 62 else x.astype(object)


def _row_sums(x: np.ndarray) -> list[int]:
    return [int(s) for s in _wide(x, len(x)).sum(0)]


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(v.isNotNull() & fine)


def _spectrum_row(part: int, s: Spectrum, sums: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([s.n], pa.int64()), pa.array([[Decimal(v) for v in sums]], pa.list_(EXACT)),
         pa.array([s.mean]), pa.array([s.values]), pa.array([s.basis.ravel()])],
        ["part", "n", "sums", "mean", "eigenvalues", "basis"])


def _of_row(row: dict) -> tuple[Spectrum, list[int]]:
    width = len(row["mean"])
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["eigenvalues"]),
                    np.array(row["basis"]).reshape(width, width)), [int(s) for s in row["sums"]]


def _partition_spectra(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, sums = Spectrum.empty(width), [0] * width
        for batch in batches:
            x = whole_entries(batch.column(1), width)
            sums = [a + b for a, b in zip(sums, _row_sums(x))]
            distinct, count = np.unique(x, axis=0, return_counts=True)
            for row, weight in zip(distinct.astype("float64"), count.tolist()):
                spectrum.add(row, weight)
        if spectrum.n:
            yield _spectrum_row(TaskContext.get().partitionId(), spectrum, sums)
    return run


def _combined(key: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    spectrum, sums = _of_row(rows[0])
    for row in rows[1:]:
        other, more = _of_row(row)
        spectrum.merge(other)
        sums = [a + b for a, b in zip(sums, more)]
    return pa.Table.from_batches([_spectrum_row(rows[0]["part"] // FAN, spectrum, sums)])


class Model:
    """n, exact sums, components (columns, by falling eigenvalue), their eigenvalues, the trace and the identity error."""

    def __init__(self, n: int, sums: list[int], basis: np.ndarray):
        self.n, self.sums, self.basis = n, sums, basis
        self.values = np.zeros(basis.shape[1])
        self.trace = self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S, exact, and x - S/n."""
        whole = max((abs(s) for s in self.sums), default=0) < 1 << 62
        wide = _wide(x, 2 * self.n) if whole else x.astype(object)
        y = wide * self.n - np.array(self.sums, "int64" if wide.dtype != object else object)
        return y, y.astype("float64") / self.n

    def components(self, count: int) -> np.ndarray:
        """Unit vectors divided by the root of their eigenvalue; NaN where there is no variance."""
        least = self.trace * EPS * len(self.values)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values[:count] > least, 1 / np.sqrt(np.maximum(self.values[:count], 0)), np.nan)
        return self.basis[:, :count] * scale


def _summed_products(rows: DataFrame, width: int, model: Model, project: np.ndarray) -> np.ndarray:
    """sum of p p^T over the rows, p the centred row in the columns of ``project``; added up by Spark, entry by entry."""
    k = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            p = model.centred(whole_entries(batch.column(1), width))[1] @ project
            total += p.T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["at", "value"])

    got = rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(k * k)
    for r in got:
        out[r["at"]] = r["value"]
    return out.reshape(k, k)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of ``valid_vectors``' rows; None where there is nothing to whiten."""
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if not width:
        return None
    spectra = cut_lineage(rows.mapInArrow(_partition_spectra(width), SPECTRA))
    left = spectra.agg(F.max("part")).first()[0] + 1
    while left > 1:
        spectra = spectra.groupBy(F.expr(f"part div {FAN}")).applyInArrow(_combined, SPECTRA)
        left = -(-left // FAN)
    spectrum, sums = _of_row(spectra.first().asDict())
    model = Model(spectrum.n, sums, np.linalg.qr(spectrum.basis)[0])
    ritz = _summed_products(rows, width, model, model.basis) / model.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    model.values, model.basis = np.maximum(values[::-1], 0), model.basis @ turn[:, ::-1]
    model.trace = float(model.values.sum())
    unit = model.components(components)
    unit = unit[:, ~np.isnan(unit).any(0)]
    if unit.shape[1]:
        cov = _summed_products(rows, width, model, unit) / model.n
        model.identity_error = float(np.abs(cov - np.eye(unit.shape[1])).max())
    return model


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining vector and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``; deviation is decimal(38,0)."""
    valid = valid_vectors(rows, id_col, vector_col)
    model = fit(valid, components)
    if model is None:
        return (rows.sparkSession.createDataFrame([], RESULT)
                .select("vec_id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened",
                        F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error")))
    width, unit = model.basis.shape[0], model.components(components)
    k = unit.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, centred = model.centred(whole_entries(batch.column(1), width))
            most = int(np.abs(y).max(initial=0))
            y = y if most * most * width < 1 << 62 else y.astype(object)
            deviation = [Decimal(int(v)) for v in (y * y).sum(1)]
            out = centred @ unit
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), k) if not batch.column(0).null_count
                          else [i for i in batch.column(0).to_pylist() for _ in range(k)], pa.int64()),
                 pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), len(out))),
                 pa.array([v for v in deviation for _ in range(k)], EXACT),
                 pa.array(out.ravel(), from_pandas=True)],
                ["vec_id", "component", "deviation", "whitened"])

    share = F.array(*[F.lit(float(v / model.trace) if model.trace else None).cast("double") for v in model.values[:k]])
    return valid.mapInArrow(run, RESULT).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("component") - 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
