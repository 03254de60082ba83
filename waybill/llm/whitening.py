"""Whitened embeddings by pivoted Cholesky and one-sided Jacobi.

Spark does what grows with the table: it finds the distinct vectors, adds them
up and sums the products of their centred entries, a matrix of one row per
dimension. The driver factors that matrix. Pivoted Cholesky takes the largest
remaining variance in every step and stops where none is left, so that
dependent dimensions give fewer columns. One-sided Jacobi then rotates the
columns of the triangular factor until each is orthogonal to all others: the
square of a column's norm is an eigenvalue, the column itself the component.
The covariance is never factored a second time, so small eigenvalues keep
their digits.

A task holds one batch of vectors and one matrix of dimensions by dimensions,
and sends the latter on once; the driver holds one such matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import ship, staged

COMPONENTS = 16
#: Entries are counted in this many steps per unit, from this base.
STEPS, BASE = 64, 1_000_000
#: Entries of more steps than this count as this many.
MOST_STEPS = 2.0**62
_EPS = np.finfo(float).eps
_SWEEPS = 60


def cholesky(matrix: np.ndarray) -> np.ndarray:
    """Columns ``c`` with ``c @ c.T`` = ``matrix``, largest remaining variance first.

    Rows of ``matrix`` in the order of the pivots would make it triangular.
    Columns end where the remaining variance is rounding noise.
    """
    rest = np.diagonal(matrix).copy()
    size = len(rest)
    noise = size * _EPS * rest.max(initial=0.0)
    factor = np.zeros((size, size))
    free = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.where(free, rest, -np.inf).argmax())
        if not rest[pivot] > noise:
            return factor[:, :k]
        free[pivot] = False
        scale = np.sqrt(rest[pivot])
        column = (matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / scale
        factor[free, k] = column[free]
        factor[pivot, k] = scale
        rest[free] -= column[free] ** 2
    return factor


def jacobi(columns: np.ndarray) -> np.ndarray:
    """``columns`` rotated among themselves until they are orthogonal, longest first.

    A round rotates half as many pairs as there are columns side by side, each
    column once; in a sweep every column meets every other.
    """
    turned = columns.copy()
    if turned.shape[1] % 2:
        turned = np.hstack([turned, np.zeros((len(turned), 1))])
    half = turned.shape[1] // 2
    order = np.arange(2 * half)
    for _ in range(_SWEEPS):
        moved = False
        for _ in range(2 * half - 1):
            p, q = order[:half], order[half:][::-1]
            left, right = turned[:, p], turned[:, q]
            a, b, c = (left**2).sum(axis=0), (right**2).sum(axis=0), (left * right).sum(axis=0)
            turn = np.abs(c) > _EPS * np.sqrt(a * b)
            if turn.any():
                moved = True
                p, q, a, b, c = p[turn], q[turn], a[turn], b[turn], c[turn]
                left, right = left[:, turn], right[:, turn]
                with np.errstate(over="ignore"):
                    zeta = (b - a) / (2 * c)
                    tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                cosine = 1 / np.hypot(1, tangent)
                sine = cosine * tangent
                turned[:, p], turned[:, q] = cosine * left - sine * right, sine * left + cosine * right
            order = np.concatenate([order[:1], order[-1:], order[1:-1]])
        if not moved:
            break
    norms = np.sqrt((turned**2).sum(axis=0))
    return turned[:, np.argsort(-norms, kind="stable")]


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors as columns, and their eigenvalues, falling; at most ``most``.

    Only eigenvalues above rounding noise have a column. The largest entry of
    each is positive.
    """
    turned = jacobi(cholesky(covariance))
    norms = np.sqrt((turned**2).sum(axis=0))
    turned, norms = turned[:, norms > 0][:, :most], norms[norms > 0][:most]
    vectors = turned / norms
    if vectors.size:
        largest = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.sign(vectors[largest, np.arange(len(norms))])
    return vectors, norms**2


@dataclass(frozen=True)
class Centre:
    """The number of distinct vectors and their exact sums per dimension."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared, exact; None beyond a long."""
        near = (self.centred(x) ** 2).sum(axis=1) * float(self.n) ** 2
        word = (1 << 64) - 1
        sums = np.array([s & word for s in self.sums], np.uint64)
        # Unsigned numbers wrap, so this is right wherever the result fits.
        wrapped = x.astype(np.uint64) * np.uint64(self.n) - sums
        found = (wrapped * wrapped).sum(axis=1, dtype=np.uint64)
        exact: list[int | None] = found.tolist()
        for i in np.flatnonzero(near > 0.99 * 2.0**63):
            exact[i] = None
            if near[i] < 1.01 * 2.0**63:
                total = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
                exact[i] = total if total < 1 << 63 else None
        return exact


def _entries(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, size)


def _centre(fit: DataFrame, size: int) -> Centre:
    """Sums per dimension, added as Python integers in tasks and as decimals between them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            x = _entries(batch, size)
            # Halves of 31 and 32 bits, so that sums over a batch fit.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + part for s, h, part in zip(sums, high, low)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(size), pa.int32()),
                    pa.array([n] * size, pa.int64()),
                    pa.array(map(Decimal, sums), pa.decimal128(38, 0)),
                ],
                names=["dimension", "n", "total"],
            )

    parts = fit.mapInArrow(add, "dimension int, n long, total decimal(38,0)")
    found = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = found.orderBy("dimension").collect()
    return Centre(rows[0]["n"], tuple(int(row["total"]) for row in rows))


def _products(fit: DataFrame, size: int, centre: Centre, onto: np.ndarray | None) -> np.ndarray:
    """Covariance of the centred vectors, projected on the columns of ``onto`` if given."""
    width = size if onto is None else onto.shape[1]
    rows, columns = np.tril_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            z = centre.centred(_entries(batch, size))
            z = z if onto is None else z @ onto
            total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows.astype(np.int32)),
                pa.array(columns.astype(np.int32)),
                pa.array(total[rows, columns]),
            ],
            names=["i", "j", "product"],
        )

    parts = fit.mapInArrow(add, "i int, j int, product double")
    found = parts.groupBy("i", "j").agg(F.sum("product").alias("product")).toPandas()
    matrix = np.zeros((width, width))
    i, j, product = (found[name].to_numpy() for name in ("i", "j", "product"))
    matrix[i, j] = matrix[j, i] = product / centre.n
    return matrix


def steps(vector: Column) -> Column:
    """The entries as whole steps; NULL for a vector that is NULL or holds a NULL or non-finite one."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.lit(MOST_STEPS)
    counted = F.transform(
        doubles,
        lambda c: F.floor(F.greatest(F.least(c * F.lit(float(STEPS)), most), -most)) + F.lit(BASE),
    )
    return F.when(finite, counted)


def whiten(
    vectors: DataFrame,
    most: int = COMPONENTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per usable row and component: its whitened coordinate and what belongs to it.

    Entries count as x = floor(64 c) + 1,000,000. Means and covariances are
    over the distinct vectors, each once, with their number n as divisor.
    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation
    (sum of (n x - S)^2, exact, NULL beyond a long), whitened, explained (share
    of the whole variance) and identity_error (largest difference of the
    whitened covariance from the identity, one value).

    Rows whose vector is NULL or holds a NULL or non-finite entry are left out,
    and so are vectors of another length than most distinct ones (the longer of
    equals). Entries beyond 2^62 steps count as 2^62. Ids may be NULL or
    repeat: every row has its own result. Dependent dimensions and few or equal
    vectors give fewer components than ``most``; without any variance, as in an
    empty table, there are no rows.
    """
    ship(vectors.sparkSession)
    schema = (
        "vec_id long, component int, n long, deviation long,"
        " whitened double, explained double, identity_error double"
    )
    usable = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), steps(F.col(vector_column)).alias("x")
    ).filter(F.col("x").isNotNull())
    fit = staged(usable.select("x").distinct(), "vectors")
    lengths = fit.groupBy(F.size("x").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    fit, usable = (frame.filter(F.size("x") == size) for frame in (fit, usable))
    centre = _centre(fit, size)
    covariance = _products(fit, size, centre, None)
    directions, values = components(covariance, most)
    onto = directions / np.sqrt(values)
    explained = values / np.trace(covariance)
    count = len(values)
    error = _products(fit, size, centre, onto) - np.eye(count)
    identity_error = float(np.abs(error).max(initial=0.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _entries(batch, size)
            each = pa.array(np.repeat(np.arange(len(x)), count))
            whitened = centre.centred(x) @ onto
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), centre.n)),
                    pa.array(centre.deviations(x), pa.int64()).take(each),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), identity_error)),
                ],
                names=[part.split()[0] for part in schema.split(",")],
            )

    return usable.mapInArrow(project, schema)
