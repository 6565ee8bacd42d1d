"""Whitening of embeddings on their leading principal components.

Entries become whole numbers, so sums are exact. Each task adds up the products
of its centred vectors; only one matrix of dimension by dimension per task goes
on, and their sum to the driver. There a Householder reduction makes the
covariance tridiagonal, Sturm counts bisect its leading eigenvalues, and inverse
iteration finds their vectors, orthogonalised again inside clusters of close
eigenvalues. The few component vectors are sent to every task, which projects.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries are multiplied by the one, cut to whole numbers, and the other is added.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues closer than this share of the norm form a cluster.
CLUSTER = 1e-3
#: A component with less than this share of the variance is rounding noise and has no direction.
LEAST_SHARE = 1e-13


class Fit(NamedTuple):
    """What the fit list determines; its size is bounded by the dimension."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole_numbers(vector: Column) -> Column:
    """The entries as longs; null for a vector that is null or holds null or non-finite entries."""
    each = vector.cast("array<double>")
    fine = F.forall(each, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(fine, F.transform(each, lambda c: F.floor(c * SCALE).cast("long") + SHIFT))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n as doubles: the whole part of the mean is taken off exactly, then the rest."""
    low = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - low).astype(float) - rest


def _sums(dimension: int):
    """Per task, the exact sum of each entry; halves of 32 bits cannot overflow."""

    def add(batches):
        from decimal import Decimal

        total = np.zeros(dimension, object)
        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            total += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension, dtype=np.int32)), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["i", "s"])

    return add


def _products(dimension: int, n: int, sums: list[int], directions: np.ndarray | None = None):
    """Per task, the upper triangle of the sum of products of its centred vectors, projected first if asked."""

    def add(batches):
        width = dimension if directions is None else directions.shape[1]
        total = np.zeros((width, width))
        for batch in batches:
            y = centred(_matrix(batch.column("x"), dimension), n, sums)
            y = y if directions is None else y @ directions
            total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"])

    return add


def _covariance(fit: DataFrame, width: int, products, n: int) -> np.ndarray:
    """The symmetric matrix of the summed products over ``n``."""
    out = np.zeros((width, width))
    for r in fit.mapInArrow(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.value / n
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with q.T @ matrix @ q tridiagonal, by Householder reflections."""
    a, size = matrix.astype(float).copy(), len(matrix)
    q = np.eye(size)
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0 or not v[1:].any():
            continue
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot, below = diagonal[0] - at, np.zeros(len(at), np.int64)
    below += pivot < 0
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - e * e / pivot
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected until its interval no longer shrinks."""
    size = len(diagonal)
    edge = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = np.full(count, (diagonal - edge).min()), np.full(count, (diagonal + edge).max())
    rank = size - 1 - np.arange(count)
    while True:
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        above = sturm_count(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - value) x = right by elimination with row exchanges."""
    size = len(diagonal)
    main, up, second = diagonal - value, np.append(off, 0.0), np.zeros(size)
    x = right.astype(float).copy()
    for k in range(size - 1):
        below = off[k]
        if abs(below) > abs(main[k]):
            factor = main[k] / below
            main[k], up[k], second[k], main[k + 1], up[k + 1] = below, main[k + 1], up[k + 1], up[k] - factor * main[k + 1], -factor * up[k + 1]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            factor = below / (main[k] if abs(main[k]) > least else least)
            main[k + 1] -= factor * up[k]
            x[k + 1] -= factor * x[k]
    for k in range(size - 1, -1, -1):
        pivot = main[k] if abs(main[k]) > least else np.copysign(least, main[k])
        x[k] = (x[k] - (up[k] * x[k + 1] if k + 1 < size else 0.0) - (second[k] * x[k + 2] if k + 2 < size else 0.0)) / pivot
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix by inverse iteration.

    Values that are close follow each other by a hair, and the vectors of their
    cluster are made orthogonal to each other after every step.
    """
    size, rng = len(diagonal), np.random.default_rng(7)
    norm = max(np.abs(diagonal).max() + 2 * (np.abs(off).max() if len(off) else 0.0), np.finfo(float).tiny)
    hair = np.finfo(float).eps * norm
    found, first = np.zeros((size, len(values))), 0
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(value, shift - 10 * hair) if k > first else value
        x = rng.standard_normal(size)
        for _ in range(6):
            for _ in range(2):
                x -= found[:, first:k] @ (found[:, first:k].T @ x)
            x /= np.linalg.norm(x)
            x = _solve(diagonal, off, shift, x, hair)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= found[:, first:k] @ (found[:, first:k].T @ x)
            x /= np.linalg.norm(x)
        found[:, k] = x
    return found


def eigen(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    size = len(matrix)
    if not matrix.any():
        return np.zeros(min(count, size)), np.eye(size)[:, :count]
    diagonal, off, q = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(count, size))
    return values, q @ leading_vectors(diagonal, off, values)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Fit, DataFrame] | None:
    """(fit, fit list) of the distinct whole-number vectors ``x``; None without any."""
    distinct = cut_lineage(vectors.select("x").distinct(), "fit")
    sizes = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return None
    n, dimension = sizes[0].n, sizes[0].d
    added = distinct.mapInArrow(_sums(dimension), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    sums = [int(r.s) for r in added.orderBy("i").collect()]
    covariance = _covariance(distinct, dimension, _products(dimension, n, sums), n)
    values, directions = eigen(covariance, components)
    trace = float(np.trace(covariance))
    kept = values > LEAST_SHARE * max(trace, np.finfo(float).tiny)
    return Fit(n, sums, values[kept], directions[:, kept], trace), distinct


def _projected(found: Fit, error: float):
    dimension, count = len(found.sums), len(found.values)
    scaled = found.vectors / np.sqrt(found.values)
    explained = found.values / found.trace if count else found.values
    sums = np.array(found.sums, object)

    def deviations(x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S) ** 2, in 64 bits where they cannot overflow."""
        far = max((max(abs(found.n * int(x[:, k].max()) - s), abs(found.n * int(x[:, k].min()) - s)) for k, s in enumerate(found.sums)), default=0)
        if max(far * far * dimension, found.n * int(np.abs(x).max(initial=0)), *map(abs, found.sums)) < 1 << 63:
            y = found.n * x - sums.astype(np.int64)
            return [int(v) for v in (y * y).sum(axis=1)]
        return [int(v) for v in ((found.n * x.astype(object) - sums) ** 2).sum(axis=1)]

    def project(batches):
        from decimal import Decimal

        for batch in batches:
            for start in range(0, batch.num_rows if count else 0, 2048):
                part = batch.slice(start, 2048)
                rows = part.num_rows
                x = _matrix(part.column("x"), dimension)
                white = centred(x, found.n, found.sums) @ scaled
                owner = pa.array(np.repeat(np.arange(rows), count))
                far = pa.array([Decimal(v) for v in deviations(x)], pa.decimal128(38, 0))
                columns = [
                    part.column("id").take(owner), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)), pa.array(np.full(rows * count, found.n)),
                    far.take(owner), pa.array(white.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return project


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    - Rows whose vector is null or holds null, NaN or infinite entries give
      nothing, nor do vectors of another length than most rows have (of equally
      frequent lengths the longest). Vectors without entries and an empty table
      give no rows.
    - The model is fitted on each distinct vector once, so copies and repeated
      rows change nothing; each row is projected. A null id stays null.
    - There are ``components`` of them, or as many as the vectors have entries
      or directions: one with no variance beyond rounding is left out, so equal
      vectors give no rows. Equal eigenvalues (ties) have orthogonal vectors in
      no particular order.
    - deviation is exact, as decimal(38, 0).
    """
    rows = df.select(F.col(f"`{vec_id}`").alias("id"), whole_numbers(F.col(f"`{vector}`")).alias("x")).where("x is not null and size(x) > 0")
    length = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("held")).orderBy(F.desc("held"), F.desc("size")).first()
    rows = rows.where(F.size("x") == (length.size if length else 0))
    id_type = df.schema[vec_id].dataType.simpleString()
    out = f"id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], out)
    found, distinct = model
    error = 0.0
    if len(found.values):
        white = _covariance(distinct, len(found.values), _products(len(found.sums), found.n, found.sums, found.vectors / np.sqrt(found.values)), found.n)
        error = float(np.abs(white - np.eye(len(white))).max())
    return rows.mapInArrow(_projected(found, error), out)
