"""Embedding whitening: shifted CholeskyQR of the centred rows, R factors composed, then the SVD of R."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

UNIT = np.finfo(np.float64).eps / 2
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and x = floor(scale * c) of every vector without null or non-finite entries.

    Entries beyond the range of a long become its ends. An empty vector has no components and is left out.
    """
    c = F.col("embedding").cast("array<double>")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda v: F.floor(v * scale)).alias("x"))


def matrix_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


@dataclass
class Centre:
    """The number of rows and the exact sum of each dimension."""

    n: int
    sums: list[int]
    most: int = field(init=False)

    def __post_init__(self):
        self.most = ((1 << 63) - 1 - max(map(abs, self.sums))) // self.n

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: 64-bit numbers where they fit, else Python's."""
        if x.size == 0 or max(-int(x.min()), int(x.max())) <= self.most:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 of every row, exactly; None where it is no long."""
        away = self.scaled(x)
        if away.dtype != object:
            about = (away.astype(np.float64) ** 2).sum(axis=1)
            fits = about < 2.0**62
            out = (np.where(fits[:, None], away, 0) ** 2).sum(axis=1).tolist()
            for i in np.flatnonzero(~fits):
                out[i] = sum(int(v) ** 2 for v in away[i])
        else:
            out = [sum(int(v) ** 2 for v in row) for row in away]
        return [v if v < 1 << 63 else None for v in out]


@dataclass
class Triangle:
    """Columns that are kept and the upper triangle R by which they are divided."""

    columns: np.ndarray
    upper: np.ndarray

    def solve(self, q: np.ndarray) -> np.ndarray:
        """The rows z with z R = q[columns], by forward substitution over the columns."""
        z = np.empty((len(q), len(self.columns)))
        for j, c in enumerate(self.columns):
            z[:, j] = (q[:, c] - z[:, :j] @ self.upper[:j, j]) / self.upper[j, j]
        return z


def cholesky(gram: np.ndarray, least: float) -> tuple[Triangle, np.ndarray]:
    """A factor F with F^T F = gram, largest pivots first, up to pivots of `least`; and the triangle of its pivot columns.

    Columns beyond depend on the pivot columns, so a table of any rank has a factor.
    """
    left, columns, rows = gram.copy(), [], []
    while len(columns) < len(gram):
        k = int(np.argmax(left.diagonal()))
        if left[k, k] <= least:
            break
        row = left[k] / np.sqrt(left[k, k])
        row[columns] = 0
        rows.append(row)
        columns.append(k)
        left -= np.outer(row, row)
        left[k] = left[:, k] = 0
    factor = np.array(rows).reshape(len(rows), len(gram))
    return Triangle(np.array(columns, int), factor[:, columns]), factor


def summed(rows: DataFrame, dim: int, values, cells: int) -> np.ndarray:
    """The sum over all rows of an array of `cells` numbers that `values` draws from each block of rows.

    Every task adds up its blocks and sends one number for each cell, which are added by cell; the
    driver gets the sums, whose number depends on the dimension alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                total += values(matrix_of(batch.slice(at, 4096), dim))
        yield pa.record_batch([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], names=["cell", "value"])

    out = np.zeros(cells)
    for r in rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r.cell] = r.value
    return out


def centre_of(rows: DataFrame, dim: int) -> Centre:
    """Exact sums: the high and low 32 bits of the entries are added apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
        for batch in batches:
            x = matrix_of(batch, dim)
            high, low, n = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), n + len(x)
        yield pa.record_batch([pa.array(np.arange(dim + 1, dtype=np.int32)), pa.array([*high.tolist(), n]), pa.array([*low.tolist(), 0])], names=["cell", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = {r.cell: (int(r.high) << 32) + int(r.low) for r in rows.mapInArrow(run, "cell int, high long, low long").groupBy("cell").agg(*whole).collect()}
    return Centre(found[dim] >> 32, [found[i] for i in range(dim)])


def gram_of(rows: DataFrame, centre: Centre, solves: list[Triangle]) -> np.ndarray:
    """Q^T Q of the centred rows after their triangular solves, by one pass over the rows."""
    dim, width = len(centre.sums), len(solves[-1].columns) if solves else len(centre.sums)
    upper = np.triu_indices(width)

    def values(x: np.ndarray) -> np.ndarray:
        q = centre.rows(x)
        for triangle in solves:
            q = triangle.solve(q)
        return (q.T @ q)[upper]

    out = np.zeros((width, width))
    out[upper] = summed(rows, dim, values, len(upper[0]))
    return np.triu(out) + np.triu(out, 1).T


def composed_r(rows: DataFrame, centre: Centre, most_passes: int = 8) -> tuple[np.ndarray, float]:
    """R with R^T R = A^T A of the centred rows A, and the sum of the squares of A.

    The first Gram matrix is shifted before it is factored, which no rounding can make indefinite; the
    rows divided by its triangle have a Gram matrix of a condition that later passes factor without
    a shift, until the rows are orthogonal. Directions in which the rows don't vary are dropped there.
    """
    dim = len(centre.sums)
    gram = gram_of(rows, centre, [])
    total = float(gram.trace())
    if total <= 0:
        return np.zeros((0, dim)), 0.0
    shift = min(11 * (centre.n * dim + dim * (dim + 1)) * UNIT, 0.01) * total
    triangle, r = cholesky(gram + shift * np.eye(dim), 0.0)
    solves = [triangle]
    for _ in range(most_passes):
        gram = gram_of(rows, centre, solves)
        triangle, factor = cholesky(gram, dim * 1e-13 * float(gram.diagonal().max()))
        r = factor @ r
        if len(factor) == len(gram) and np.abs(gram - np.eye(len(gram))).max() <= 1e-10:
            return r, total
        solves.append(triangle)
    raise ArithmeticError("the rows did not become orthogonal")


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: principal components of unit variance.

    Entries c become x = floor(scale * c). Mean and covariance are those of the distinct x vectors (n
    of them, with sums S), so copies have no weight; they are written once and read by each pass. Each
    pass sums Gram matrices of the rows, solved by the triangles so far, and the driver factors a
    matrix of dimension by dimension; the SVD of the composed R gives the components. Every
    remaining row then gives one row for each component: its deviation (sum of (n x - S)^2, exact, null
    where it exceeds a long), x - S/n on the component over its standard deviation, and the
    component's share of the variance. identity_error is the largest absolute entry of the whitened
    distinct vectors' covariance minus the identity.

    Vectors that are null, empty or hold null or non-finite entries take no part, nor do vectors of
    another length than most (of equal counts the longer). Repeated rows give repeated results, a null
    vec_id stays null. Components in which the vectors don't vary can't be whitened and are left out: there are
    none for a single distinct vector or an empty table. Other columns are left out.
    """
    spark = embeddings.sparkSession
    good = whole_vectors(embeddings, scale)
    size = good.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if size is None:
        return spark.createDataFrame([], OUT)
    dim = size.dim
    good = good.where(F.size("x") == dim)
    fit = written(good.select("x").distinct(), "vectors")
    centre = centre_of(fit, dim)
    r, total = composed_r(fit, centre)
    _, stretch, axes = np.linalg.svd(r, full_matrices=False)
    stretch, axes = stretch[:components], axes[:components]
    kept = stretch > 0
    stretch, axes = stretch[kept], axes[kept]
    if not len(axes):
        return spark.createDataFrame([], OUT)
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    turn, explained = axes.T / (stretch / np.sqrt(centre.n)), stretch**2 / total
    count = len(axes)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centre.rows(x) @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = summed(fit, dim, moments, count + count * count) / centre.n  # whitened rows are centred already; what rounding leaves of their mean is taken off
    error = float(np.abs(sums[count:].reshape(count, count) - np.outer(sums[:count], sums[:count]) - np.eye(count)).max())
    discard(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch, dim)
            rows, ids = len(x), batch.column(0)
            yield pa.record_batch(
                [
                    ids.take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, centre.n)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array((centre.rows(x) @ turn).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return good.mapInArrow(run, OUT)
