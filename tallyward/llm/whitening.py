"""Embedding whitening: principal components by pivoted Cholesky and one-sided Jacobi, projected to unit variance.

Entries become whole numbers first (``floor(1024 * c) + 100000``), so sums and products about a whole centre next to the mean are
exact in any order while they fit a double's 53 bits.  Two passes sum the vectors and their centred products per task, and one matrix
of d x d numbers (``MAX_DIMENSIONS`` bounds it) reaches the driver.  There its pivoted Cholesky factor L (scatter = L L') is rotated from the
right until its columns are orthogonal: the rotated matrix is U diag(s), so column norms give the eigenvalues s^2 and
normalised columns the components U, and no eigenvector matrix is accumulated.  A third pass projects every row.

Edge cases: rows whose vector is NULL, empty, or holds NULL, NaN, infinite or huge entries (beyond 2^42 in size, where the whole numbers would
not be exact) are left out, as are rows of another length than most.  Repeated rows and NULL ids count and return like others.  Directions without any variance are no
components: one row alone, or equal rows only, return nothing.  An empty table returns nothing.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import ship, stored
from tallyward.llm.vectors import dimension, finite, matrix

SCALE, SHIFT = 1024, 100000
HUGE = float(1 << 42)
COMPONENTS = 8
ROWS = 4096  # multiplied at once
SWEEPS = 60
EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class Basis:
    """Whole-number sums of ``n`` vectors, their components (columns, by falling eigenvalue) and the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([round_half_up(s, self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Means minus ``centre``, each from exact whole numbers."""
        return np.array([(s - round_half_up(s, self.n) * self.n) / self.n for s in self.sums])


def round_half_up(s: int, n: int) -> int:
    return (2 * s + n) // (2 * n)


def whole(rows: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * rows).astype(np.int64) + SHIFT


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with a[order][:, order] = L L'; L has one column per direction that is more than rounding."""
    d = len(a)
    order, factor, left = np.arange(d), np.zeros((d, d)), np.diag(a).astype(np.float64)
    most = left.max(initial=0.0)
    for k in range(d):
        best = k + int(np.argmax(left[k:]))
        if left[best] <= d * EPS * most:
            return order, factor[:, :k]
        for values in (order, left, factor):
            values[[k, best]] = values[[best, k]]
        factor[k, k] = np.sqrt(left[k])
        below = slice(k + 1, d)
        factor[below, k] = (a[order[below], order[k]] - factor[below, :k] @ factor[k, :k]) / factor[k, k]
        left[below] -= factor[below, k] ** 2
    return order, factor


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor's columns rotated against each other until all are orthogonal; a round rotates disjoint pairs at once."""
    rows = np.ascontiguousarray(factor.T)  # columns as rows
    count = len(rows)
    seats = np.arange(count + count % 2)  # a tournament table; an odd one out rests
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (p < count) & (q < count)
            p, q = p[real], q[real]
            x, y = rows[p], rows[q]
            alpha, beta, gamma = (np.einsum("ij,ij->i", u, v) for u, v in ((x, x), (y, y), (x, y)))
            size = np.sqrt(alpha * beta)
            skew = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, skew.max(initial=0.0))
            turn = skew > EPS
            gamma = np.where(turn, gamma, 1.0)
            zeta = (beta - alpha) / (2 * gamma)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            rows[p], rows[q] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            seats[1:] = np.roll(seats[1:], 1)
        if worst <= 4 * EPS:
            break
    return rows.T


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the scatter, falling, and unit eigenvectors as columns."""
    order, factor = pivoted_cholesky(scatter)
    turned = jacobi(factor)
    norms = np.sqrt(np.einsum("ij,ij->j", turned, turned))
    by_size = np.argsort(-norms, kind="stable")
    out = np.empty_like(turned)
    out[order] = turned
    return norms[by_size] ** 2, out[:, by_size] / norms[by_size]


def usable(vectors: DataFrame, column: str) -> DataFrame:
    small = F.forall(column, lambda c: F.abs(c) <= HUGE)
    return vectors.where(finite(F.col(column)) & small)


def _chunks(batches: Iterator[pa.RecordBatch], column: str, d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield whole(matrix(batch.column(column).slice(lo, ROWS), d))


def _sums(column: str, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for x in _chunks(batches, column, d):
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(total)], ["i", "n", "s"])

    return run


def _scatter(column: str, d: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((d, d))
        for x in _chunks(batches, column, d):
            z = (x - centre).astype(np.float64)
            n, total = n + len(x), total + z.T @ z
        if n:
            yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    return run


def fit(vectors: DataFrame, column: str = "embedding") -> Basis | None:
    """Sums and components of all usable vectors; None where there are none."""
    ship(vectors.sparkSession)
    rows = usable(vectors, column).select(column)
    d = dimension(rows, column)
    if not d:
        return None
    rows = rows.where(F.size(column) == d)
    whole_sum = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")  # one row per task and dimension
    found = sorted(rows.mapInArrow(_sums(column, d), "i int, n bigint, s bigint").groupBy("i").agg(F.sum("n").alias("n"), whole_sum).collect())
    basis = Basis(found[0]["n"], tuple(int(r["s"]) for r in found), np.zeros(0), np.zeros((d, 0)), 0.0)
    tasks = rows.mapInArrow(_scatter(column, d, basis.centre), "i int, row array<double>")
    cells = tasks.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    scatter = np.zeros((d, d))
    scatter[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    scatter -= basis.n * np.outer(basis.rest, basis.rest)
    values, components = principal((scatter + scatter.T) / 2)
    return Basis(basis.n, basis.sums, values / basis.n, components, float(np.trace(scatter)) / basis.n)


def _squares(x: np.ndarray, basis: Basis) -> pa.Array:
    """Sums of squares of n*x - S, exact; NULL beyond a long."""
    shifted = [s - basis.n * int(m) for s, m in zip(basis.sums, basis.centre)]
    z = x - basis.centre
    most = basis.n * int(np.abs(z).max(initial=0)) + max(map(abs, shifted))
    if most * most * len(shifted) < 1 << 63:
        y = basis.n * z - np.array(shifted, np.int64)
        return pa.array(np.einsum("ij,ij->i", y, y))
    exact = [sum((basis.n * v - s) ** 2 for v, s in zip(row, shifted)) for row in z.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _project(ident: str, column: str, d: int, basis: Basis, count: int):
    axes = basis.components[:, :count] / np.sqrt(basis.eigenvalues[:count])
    centre, rest = basis.centre, basis.rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                x = whole(matrix(part.column(column), d))
                white = ((x - centre) - rest) @ axes
                flat = pa.array(white.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, count, dtype=np.int32)), flat)
                yield pa.record_batch([part.column(ident), _squares(x, basis), lists], [ident, "deviation", "white"])

    return run


def whiten(vectors: DataFrame, basis: Basis | None, count: int = COMPONENTS, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row per usable vector: its id, deviation (sum over dimensions of (n*x-S)^2) and white, the list of its first ``count`` whitened coordinates."""
    kind = vectors.schema[ident].dataType.simpleString()
    schema = f"{ident} {kind}, deviation bigint, white array<double>"
    count = min(count, len(basis.eigenvalues)) if basis else 0
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    ship(vectors.sparkSession)
    d = len(basis.sums)
    rows = usable(vectors, column).where(F.size(column) == d).select(ident, column)
    return rows.mapInArrow(_project(ident, column, d, basis, count), schema)


def identity_error(white: DataFrame, count: int) -> float | None:
    """The largest absolute entry of the covariance of ``white`` minus the identity; None without rows."""
    cell = lambda a: F.col("white")[a]
    if not count:
        return None
    means = white.agg(*[F.avg(cell(a)) for a in range(count)]).first()
    if means[0] is None:
        return None
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    cov = white.agg(*[F.avg((cell(a) - means[a]) * (cell(b) - means[b])) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(cov, pairs))


def whitened_components(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """Fit and apply: vec_id, component (from 1), n, deviation, whitened, explained and identity_error; a row per usable vector and component."""
    basis = fit(vectors)
    white = stored(whiten(vectors, basis, count), "white")
    held = min(count, len(basis.eigenvalues)) if basis else 0
    share = F.array(*[F.lit(float(e / basis.trace)) for e in basis.eigenvalues[:held]]) if held else F.array().cast("array<double>")
    error = F.lit(identity_error(white, held)).cast("double")
    rows = white.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(basis.n if basis else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("k") + 1).alias("explained") if held else F.lit(None).cast("double").alias("explained"),
        error.alias("identity_error"),
    )
