"""Whitening of embeddings by the eigenvectors of their covariance.

Entries become integers, floor(256 c). Distinct vectors are the fit list, in a table; Spark
sums their entries, and tasks sum the products of their centred entries, a row of the scatter
matrix at a time. Only that matrix, of a size set by the dimension alone, reaches the driver.
There a Cholesky factorisation with diagonal pivoting gives a triangular factor L, V = L L',
and one-sided Jacobi rotations make the columns of L orthogonal: the squared norms of the
rotated columns are the eigenvalues of V, the normalised columns its eigenvectors, to a high
relative accuracy since V is never squared. Rows are projected in one pass without a shuffle.

Defined results: rows whose vector is null or holds null, NaN or infinity are dropped; so is
nothing else. Entries beyond a long take its nearest value. Shorter vectors count as zeros
from their end on (and as vectors of their own in the fit list); an empty one is all zeros.
Components have a positive eigenvalue, so a list of rank r gives r of them: one distinct
vector, or none, gives no rows. A deviation beyond a long is null. Repeated rows and null ids
give a row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean_batches, map_batches, materialise

SCALE = 256
LONG = 1 << 63
#: Rows of one product of centred entries.
ROWS = 4096


def integers(vector: Column) -> Column:
    """floor(256 c) of each entry as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite entry."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _table(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows, with zeros where one is short."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: in longs where they hold it, else in whole numbers of any size."""
    largest = int(np.abs(x.astype(np.float64)).max(initial=0.0)) + 1
    if n * largest + max(map(abs, sums), default=0) < LONG >> 2:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(spread: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None beyond a long."""
    if spread.dtype != object:
        largest = int(np.abs(spread).max(initial=0))
        if largest * largest * max(1, spread.shape[1]) < LONG:
            return (spread * spread).sum(1).tolist()
    found = [sum(int(c) * int(c) for c in row) for row in spread]
    return [s if s < LONG else None for s in found]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _spread(x, n, sums).astype(np.float64) / n


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with v = L L', its rows in the order of ``v``, a column for each rank: the largest remaining diagonal entry goes first."""
    a, d = v.astype(np.float64).copy(), len(v)
    factor = np.zeros((d, d))
    order = np.arange(d)
    least = np.finfo(float).eps * d * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(a.diagonal()[k:].argmax())
        if a[p, p] <= least:
            break
        for m in (a, a.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    else:
        k = d
    out = np.zeros((d, k))
    out[order] = factor[:, :k]
    return out


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of L L': columns are rotated in disjoint pairs until all are orthogonal."""
    a = factor.copy()
    r = a.shape[1]
    ring = list(range(r + r % 2))  # an odd number gets a partner that stands for nothing
    small = np.finfo(float).eps * max(8, a.shape[0])
    last = np.inf
    for _ in range(sweeps if r > 1 else 0):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(ring[i], ring[-1 - i]) for i in range(len(ring) // 2)]
            p, q = np.array([x for x in pairs if max(x) < r]).T
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, np.finfo(float).tiny))
            worst = max(worst, float(cosine.max()))
            turn = cosine > np.finfo(float).eps
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            ring[1:] = [ring[-1], *ring[1:-1]]
        if worst <= small and (worst <= small / 8 or worst >= last):
            break
        last = worst
    e = (a * a).sum(0)
    order = np.argsort(-e, kind="stable")
    order = order[e[order] > 0]
    return e[order], a[:, order] / np.sqrt(e[order])


@dataclass(frozen=True)
class Model:
    """Size and entry sums of the fit list, the leading eigenvalues and eigenvectors (columns) of its covariance, and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums) @ self.vectors / np.sqrt(self.values)


def _scatter(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Sum of the products of centred entries: each task adds up its rows, Spark adds up the tasks."""
    dim = len(sums)
    lean_batches(fit.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                c = _centred(_table(batch["x"].slice(at, ROWS), dim), n, sums)
                total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "line"])

    lines = fit.mapInArrow(run, "i int, line array<double>").groupBy("i").agg(F.collect_list("line").alias("lines"))
    zero = F.array_repeat(F.lit(0.0), dim)
    added = lines.select("i", F.aggregate("lines", zero, lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("line"))
    return np.array([r["line"] for r in added.orderBy("i").collect()]).reshape(dim, dim)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct x once, as a table; copies meet on the map side first."""
    return materialise(vectors.select("x").distinct(), "whitening-fit")


def learn(fit: DataFrame, components: int = 4) -> Model | None:
    """The model of a fit list, None if it is empty."""
    n = fit.count()
    at = {r["at"]: int(r["s"]) for r in fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).collect()}
    if not n or not at:
        return None
    sums = [at[k] for k in range(len(at))]
    v = _scatter(fit, n, sums) / n
    e, u = jacobi(pivoted_cholesky((v + v.T) / 2))
    return Model(n, sums, e[:components], u[:, :components], float(np.trace(v)))


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from its rows: means and products of tasks, merged."""
    dim, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                w = model.whiten(_table(batch["x"].slice(at, ROWS), dim))
                n, mean, products = _merged((n, mean, products), (len(w), w.mean(0), (w - w.mean(0)).T @ (w - w.mean(0))))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean]), pa.array([products.ravel()])], names=["n", "mean", "products"])

    state = (0, np.zeros(k), np.zeros((k, k)))
    for r in fit.mapInArrow(run, "n long, mean array<double>, products array<double>").collect():  # a short row for each task
        state = _merged(state, (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
    return float(np.abs(state[2] / state[0] - np.eye(k)).max(initial=0.0))


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets together."""
    n = a[0] + b[0]
    if not n:
        return a
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = 4, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and leading component."""
    rows = embeddings.where(usable(F.col(vector))).select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col(vector)).alias("x"))
    fit = fit_list(rows)
    model = learn(fit, components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    error, dim, k = identity_error(fit, model), len(model.sums), len(model.values)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            m = batch.num_rows
            spread = _spread(_table(batch["x"], dim), model.n, model.sums)
            w = spread.astype(np.float64) / model.n @ model.vectors / np.sqrt(model.values)
            each = np.repeat(np.arange(m), k)
            return pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), pa.array(_squares(spread), pa.int64()).take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

        return step

    return map_batches(rows, make, SCHEMA, rows=ROWS)
