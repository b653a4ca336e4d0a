"""Whitening of embeddings: principal components of exact whole numbers, and every vector in their units.

Entries become whole numbers ``floor(1024 c) + 100000``; counts and sums of them are exact. The centred scatter is
added up from blocks of vectors, factorised by a Cholesky decomposition that takes the largest remaining
variance first, and the triangular factor is turned by one-sided Jacobi rotations until its columns are at right angles:
their lengths are the square roots of the eigenvalues, their directions the components. Vectors never leave the tasks;
what reaches the driver has the size of the number of dimensions, squared.

Defined results: a vector that is NULL or empty, or holds NULL, NaN, an infinity or an entry of 2^30 or more, takes no
part. If lengths differ, those of the most frequent length are taken (of equally frequent ones the longest). Components
without variance do not exist, so equal vectors, a single vector and an empty table give no rows. Repeated rows count as
often as they occur, a NULL id stays NULL, and other columns are ignored. ``deviation`` is NULL beyond 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import fresh, map_texts

# fixed values: entries become floor(SCALE * entry) + SHIFT
SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
LARGEST = float(1 << 30)
# a remaining variance below this share of the first one is rounding
NO_VARIANCE = 1e-13
SAFE = 1 << 62
LOW_BITS = 20


@dataclass(frozen=True)
class Whitening:
    """Sums and components of the fitted vectors: ``components`` has one unit column per eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    variance: float


def usable(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vectors take part, of one length, with double entries."""
    entries = F.col(vector).cast("array<double>")
    # NaN is larger than every number, so this refuses it too
    fits = F.forall(entries, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))
    rows = df.withColumn(vector, entries).where(fits & (F.size(vector) > 0))
    lengths = rows.groupBy(F.size(vector).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    return rows.where(F.size(vector) == (most[0]["length"] if most else 0))


def whole_numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers, without the shift."""
    vectors = batch.column(batch.schema.get_field_index(column))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(vectors), -1)


def _added(rows: DataFrame, widest: str) -> np.ndarray:
    """Rows (i, values) added up entry by entry per i; one row of figures per i reaches the driver."""

    def add(table: pa.Table) -> pa.Table:
        parts = table.column("values").combine_chunks()
        total = parts.flatten().to_numpy().reshape(len(parts), -1).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "values": pa.array([total], pa.list_(parts.type.value_type))})

    added = rows.groupBy("i").applyInArrow(add, f"i long, values array<{widest}>").collect()
    return np.array([r["values"] for r in sorted(added, key=lambda r: r["i"])])


def _sums(vectors: DataFrame, column: str) -> tuple[int, list[int]]:
    """Number of vectors, and the exact sum of each shifted entry."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch, column)
            if len(x):
                # two halves, each far from 64 bits
                halves = [(x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0), np.full(x.shape[1], len(x))]
                yield pa.record_batch({"i": pa.array(range(3), pa.int64()), "values": pa.array(halves, pa.list_(pa.int64()))})

    found = _added(map_texts(vectors.select(column), parts, "i long, values array<long>"), "long")
    if not len(found):
        return 0, []
    n = int(found[2][0])
    return n, [(int(high) << LOW_BITS) + int(low) + n * SHIFT for high, low in zip(found[0], found[1], strict=True)]


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S`` of shifted whole numbers, exact: in 64 bits where that is enough, else as Python numbers."""
    centre = [s - n * SHIFT for s in sums]
    reach = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, centre), default=0)
    if reach < SAFE:
        return n * x - np.array(centre, dtype=np.int64)
    return n * x.astype(object) - np.array(centre, dtype=object)


def _products(vectors: DataFrame, column: str, rows_of) -> np.ndarray:
    """The sum over all vectors of the outer product of ``rows_of(whole numbers)`` with itself."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(whole_numbers(batch, column))
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield pa.record_batch(
                {"i": pa.array(range(len(total)), pa.int64()), "values": pa.array(list(total), pa.list_(pa.float64()))}
            )

    return _added(map_texts(vectors.select(column), parts, "i long, values array<double>"), "double")


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with L Lᵀ = matrix: each column takes the largest variance left, rows stay in the matrix's order.

    There are as many columns as the matrix has rank.
    """
    size = len(matrix)
    factor = np.zeros((size, size))
    left = matrix.diagonal().astype(float).copy()
    smallest = NO_VARIANCE * max(left.max(initial=0.0), 0.0)
    taken = np.zeros(size, dtype=bool)
    for k in range(size):
        p = int(np.argmax(np.where(taken, -np.inf, left)))
        if left[p] <= smallest:
            return factor[:, :k]
        column = matrix[:, p] - factor[:, :k] @ factor[p, :k]
        column[taken] = 0.0
        root = math.sqrt(left[p])
        factor[:, k] = column / root
        factor[p, k] = root
        left -= factor[:, k] ** 2
        taken[p] = True
    return factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, as n - 1 rounds of pairs that share no column."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if max(a, b) < n]
        yield np.array([min(p) for p in pairs], dtype=int), np.array([max(p) for p in pairs], dtype=int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60, enough: float = 1e-15) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``factor @ factor.T``.

    The columns are turned in pairs until all are at right angles; the pairs of a round are turned together.
    """
    turned = factor.copy()
    for _ in range(sweeps):
        worst = 0.0
        for a, b in _rounds(turned.shape[1]):
            u, v = turned[:, a], turned[:, b]
            uu, vv, uv = (u * u).sum(axis=0), (v * v).sum(axis=0), (u * v).sum(axis=0)
            size = np.sqrt(uu * vv)
            slant = np.divide(np.abs(uv), size, out=np.zeros_like(uv), where=size > 0)
            turn = slant > enough
            worst = max(worst, slant.max(initial=0.0))
            # the smaller of the two angles that bring the pair to a right angle
            zeta = np.divide(vv - uu, 2 * uv, out=np.zeros_like(uv), where=turn)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            turned[:, a], turned[:, b] = cosine * u - sine * v, sine * u + cosine * v
        if worst <= 10 * enough:
            break
    lengths = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-lengths, kind="stable")
    vectors = turned[:, order] / lengths[order]
    # of either sign the one whose largest entry is positive
    largest = np.abs(vectors).argmax(axis=0)
    return lengths[order] ** 2, vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


def _centred(whitening_n: int, sums: tuple[int, ...], x: np.ndarray) -> np.ndarray:
    return deviations(x, whitening_n, sums).astype(np.float64) / whitening_n


def fit_whitening(vectors: DataFrame, column: str) -> Whitening | None:
    """The components of all vectors of ``usable``; None for an empty table."""
    n, sums = _sums(vectors, column)
    if not n:
        return None
    fixed = tuple(sums)
    covariance = _products(vectors, column, lambda x: _centred(n, fixed, x)) / n
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    return Whitening(n, fixed, values, components, float(np.trace(covariance)))


def _whitened(w: Whitening, k: int, x: np.ndarray) -> np.ndarray:
    return _centred(w.n, w.sums, x) @ (w.components[:, :k] / np.sqrt(w.eigenvalues[:k]))


def _squared(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum of squared deviations of each vector; None beyond 64 bits."""
    d = deviations(x, n, sums)
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) < SAFE:
        return (d * d).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(e) ** 2 for e in row) for row in d)]


def whitened_vectors(df: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) of every usable vector and component.

    ``deviation`` is the sum over the dimensions of (n x - S)², ``whitened`` the centred vector on the component over the
    root of its eigenvalue, ``explained`` the component's share of the variance, and ``identity_error`` the largest
    absolute difference between the covariance of all whitened vectors and the identity. See the module for NULLs,
    odd vectors, ties, repeated rows, empty tables and other columns.
    """
    key = fresh(df.select(vector), row_id)
    rows = usable(df.select(F.col(row_id).alias(key), vector), vector)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    w = fit_whitening(rows, vector)
    k = 0 if w is None else min(components, len(w.eigenvalues))
    if not k:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed(key, row_id)
    covariance = _products(rows, vector, lambda x: _whitened(w, k, x)) / w.n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = w.eigenvalues[:k] / w.variance

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch, vector)
            if not len(x):
                continue
            ids = batch.column(batch.schema.get_field_index(key)).take(pa.array(np.repeat(np.arange(len(x)), k)))
            dev = pa.array(_squared(x, w.n, w.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            size = len(x) * k
            yield pa.record_batch(
                {
                    key: ids,
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(size, w.n, dtype=np.int64)),
                    "deviation": dev,
                    "whitened": pa.array(_whitened(w, k, x).ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(size, error)),
                }
            )

    return map_texts(rows, project, schema).withColumnRenamed(key, row_id)
