"""Whitening of embeddings: leading principal components, each scaled to variance 1.

Entries become whole numbers first. Sums and the centred covariance are then exact: every task centres its rows by the
whole part of the mean, multiplies, and sends one row per cell of the covariance; what is left of the mean is taken off
as a fraction. The result does not depend on how rows are dealt to tasks. The covariance has a fixed size, the square of
the vectors' length, and is the only thing that reaches the driver. There it is tridiagonalised by Householder
reflections; counts of sign changes (Sturm) bisect the leading eigenvalues; inverse iteration finds their vectors, made
orthogonal to those of close eigenvalues. Mean and components travel with the tasks that project the rows.

Defined results: rows whose vector is NULL, of another length than most vectors, or holds NULL, NaN or infinite entries
are dropped. Repeated rows stay repeated, a NULL id stays NULL, further columns are ignored, an empty table gives an
empty result. Components whose eigenvalue is zero but for rounding have no whitened value and are left out, so equal rows
alone give no result. Entries times ``scale`` must fit 64-bit whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.llm.vectors import common_length, scaled_floor, usable

EXACT = 1 << 53
LONG = 1 << 63
CLUSTER = 1e-3
OUTPUT = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


# --- eigenvalues and eigenvectors of a small symmetric matrix


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors; vector k reflects the places from k + 1 on."""
    a = matrix.astype(np.float64).copy()
    d = len(a)
    off, reflections = np.zeros(max(d - 1, 0)), []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        off[k] = -math.copysign(length, v[0])
        v[0] -= off[k]
        size = np.linalg.norm(v)
        if size == 0:
            reflections.append(np.zeros(d - k - 1))
            continue
        v /= size
        reflections.append(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = p - (v @ p) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off, reflections


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of several places: negative pivots of the shifted matrix (Sturm)."""
    least = np.finfo(np.float64).tiny
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = diagonal[i] - at - off[i - 1] * (off[i - 1] / np.where(np.abs(q) < least, -least, q))
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, bisected until neighbouring numbers enclose them."""
    d = len(diagonal)
    radius = np.r_[0, np.abs(off)] + np.r_[np.abs(off), 0]
    low, high = np.full(k, (diagonal - radius).min()), np.full(k, (diagonal + radius).max())
    high = np.nextafter(high + np.abs(high) * 1e-15, np.inf)
    rank = d - np.arange(1, k + 1)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return low
        above = count_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def solve_shifted(diagonal: list[float], off: list[float], shift: float, right: list[float], tiny: float) -> list[float]:
    """Solution of (T - shift) x = right by elimination with row exchanges; a zero pivot counts as ``tiny``."""
    n = len(diagonal)
    main, up, up2, x = [v - shift for v in diagonal], [*off, 0.0], [0.0] * n, list(right)
    for i in range(n - 1):
        below = off[i]
        if abs(main[i]) >= abs(below):
            main[i] = main[i] or tiny
            m = below / main[i]
            main[i + 1] -= m * up[i]
            x[i + 1] -= m * x[i]
        else:
            m = main[i] / below
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = below, main[i + 1], up[i + 1], up[i] - m * main[i + 1], -m * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - m * x[i + 1]
    main[n - 1] = main[n - 1] or tiny
    for i in range(n - 1, -1, -1):
        rest = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = rest / main[i]
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as rows: inverse iteration, made orthogonal to those found for close eigenvalues."""
    n, random = len(diagonal), np.random.default_rng(1)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)))
    tiny = max(norm * np.finfo(np.float64).eps, np.finfo(np.float64).tiny)
    plain, beside = diagonal.tolist(), off.tolist()
    found = np.zeros((len(values), n))
    for j, value in enumerate(values.tolist()):
        close = found[:j][values[:j] - value <= CLUSTER * norm]
        x = random.standard_normal(n)
        for _ in range(5):
            x = np.array(solve_shifted(plain, beside, value, (x / np.linalg.norm(x)).tolist(), tiny))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= close.T @ (close @ x)
            x /= np.linalg.norm(x)
        found[j] = x
    return found


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows.

    Eigenvalues that are zero but for rounding are left out. The largest entry of a vector is positive.
    """
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    diagonal, off, reflections = tridiagonalise(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(k, len(matrix)))
    values = values[values > max(values[0], 0) * len(matrix) * np.finfo(np.float64).eps]
    vectors = tridiagonal_vectors(diagonal, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[:, at + 1 :] -= 2 * np.outer(vectors[:, at + 1 :] @ v, v)
    largest = np.abs(vectors).argmax(axis=1)
    return values * scale, vectors * np.sign(vectors[np.arange(len(vectors)), largest])[:, None]


# --- exact sums over all rows


def entries(batch: pa.RecordBatch, column: int, length: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def whole_products(rows: np.ndarray) -> np.ndarray:
    """rows^T rows of whole numbers, exactly, as Python integers or 64-bit ones."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < EXACT:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64)
    if len(rows) > 1:
        half = len(rows) // 2
        return whole_products(rows[:half]).astype(object) + whole_products(rows[half:])
    return np.outer(rows[0].astype(object), rows[0].astype(object))


def exact_sums(x: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of every entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * length
        for batch in batches:
            rows = entries(batch, 0, length)
            high, low = rows >> 32, rows & 0xFFFFFFFF
            n += len(rows)
            sums = [s + (h << 32) + w for s, h, w in zip(sums, high.sum(axis=0).tolist(), low.sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()), pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))], names=["place", "total"])

    found = x.select("x").mapInArrow(add, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total")).collect()
    total = {r["place"]: int(r["total"]) for r in found}
    return total.get(-1, 0), [total.get(i, 0) for i in range(length)]


def exact_covariance(x: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance over all rows, every cell correctly rounded from exact whole numbers."""
    length = len(sums)
    centre, rest = [s // n for s in sums], [s % n for s in sums]
    upper = np.triu_indices(length)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length), object)
        for batch in batches:
            total = total + whole_products(entries(batch, 0, length) - np.array(centre, np.int64))
        cells = pa.array([Decimal(int(v)) for v in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), cells], names=["cell", "total"])

    rows = x.select("x").mapInArrow(multiply, "cell int, total decimal(38,0)").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    matrix = np.zeros((length, length))
    for cell, total in zip(rows["cell"].to_pylist(), rows["total"].to_pylist(), strict=True):
        i, j = int(upper[0][cell]), int(upper[1][cell])
        matrix[i, j] = matrix[j, i] = (n * int(total) - rest[i] * rest[j]) / (n * n)
    return matrix


def identity_error(x: DataFrame, n: int, project: WhiteningMap) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity."""
    k = len(project.values)
    upper = np.triu_indices(k)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            rows = project.whitened(entries(batch, 0, project.length))
            squares += rows.T @ rows
            sums += rows.sum(axis=0)
        values = np.r_[squares[upper], sums]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["cell", "total"])

    rows = x.select("x").mapInArrow(multiply, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    values = np.zeros(len(upper[0]) + k)
    values[rows["cell"].to_numpy()] = rows["total"].to_numpy()
    means = values[len(upper[0]) :] / n  # zero but for rounding: rows are centred before they are projected
    covariance = values[: len(upper[0])] / n - means[upper[0]] * means[upper[1]]
    return float(np.abs(covariance - (upper[0] == upper[1])).max(initial=0.0))


class WhiteningMap:
    """Mean and components; its size depends on the vectors' length alone."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.values, self.vectors, self.trace, self.length = n, values, vectors, trace, len(sums)
        self.centre, self.rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        centred = (rows - self.centre).astype(np.float64) - self.rest / self.n
        return (centred @ self.vectors.T) / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Sum over all entries of (n * entry - sum)^2, exactly."""
        far = rows - self.centre
        if (int(np.abs(far).max(initial=0)) + 1) ** 2 * self.n**2 * self.length < LONG:
            return ((self.n * far - self.rest) ** 2).sum(axis=1).tolist()
        exact = far.astype(object) * self.n - self.rest.astype(object)
        return [int(v) for v in (exact * exact).sum(axis=1)]


def fit_whitening(x: DataFrame, length: int, components: int) -> WhiteningMap | None:
    """Mean and leading components over all rows of ``x``; None if there is nothing to whiten."""
    n, sums = exact_sums(x, length)
    if not n:
        return None
    covariance = exact_covariance(x, n, sums)
    values, vectors = leading_eigenpairs(covariance, components)
    return WhiteningMap(n, sums, values, vectors, float(np.trace(covariance))) if len(values) else None


def whiten(embeddings: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: number of rows, the vector's exact deviation, its whitened value, the
    component's share of the variance, and how far the whitened covariance is from the identity.

    Four scans of the table and no shuffle of rows; what tasks send is one row per cell of the covariance.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_column].dataType
    length = common_length(embeddings, vector_column)
    vector = embeddings[vector_column]
    kept = embeddings.filter(usable(vector, length)).select(embeddings[id_column].alias("vec_id"), F.transform(scaled_floor(vector, scale), lambda c: c + F.lit(offset)).alias("x"))
    project = fit_whitening(kept, length, components) if length else None
    if project is None:
        return spark.createDataFrame([], OUTPUT.format(id_type.simpleString()))
    error = identity_error(kept, project.n, project)
    shares = (project.values / project.trace).tolist()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = entries(batch, 1, project.length)
            whitened = project.whitened(rows)
            bounds = pa.array(np.arange(len(rows) + 1) * whitened.shape[1], pa.int32())
            deviations = pa.array([Decimal(v) for v in project.deviations(rows)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviations, pa.ListArray.from_arrays(bounds, pa.array(whitened.ravel()))], names=["vec_id", "deviation", "values"])

    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("values", T.ArrayType(T.DoubleType()))])
    placed = kept.mapInArrow(apply, schema).select("vec_id", "deviation", F.posexplode("values").alias("place", "whitened"))
    share = F.element_at(F.lit(shares), F.col("place") + 1)
    return placed.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(project.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
