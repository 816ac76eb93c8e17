"""Whitening of embedding vectors.

Vectors become integers first (``as_longs``), so that counts, sums and the
scatter are exact, whatever order tasks finish in:

1. the fit list is every distinct integer vector once; its size and sums per
   dimension are added up as integers;
2. the scatter is taken about the whole number nearest to the mean, so entries
   are small when they are multiplied; what the rounding of the mean leaves is
   taken off exactly, in whole numbers;
3. the covariance is factored by Cholesky with pivots, and one-sided Jacobi
   rotations make the columns of the triangular factor orthogonal. Their squared
   lengths are the eigenvalues, their directions the components;
4. rows are projected on the leading components in Arrow batches.

The driver holds numbers of the order of dimension squared and no vectors.

Defined results: vectors that are NULL or hold a NULL or a number that is not
finite take no part, nor do those with an entry of 2^32 or more in size (their
integers would leave 40 bits) or with another number of entries than most fit
vectors have (ties: the smaller number); repeated rows are whitened each, and
count once in the fit; components without variance are left out, so fewer than
asked for may come back, and none for a single vector; an empty table gives no
rows; a component's largest entry is positive; a deviation beyond 64 bits is
NULL; other columns stay as they are, and new ones get a longer name where
theirs is taken.
"""
from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh_name, ship
from tidewater.session import materialise

SCALE = 256.0
LARGEST = float(1 << 32)
COMPONENTS = 4
SWEEPS = 60
_EXACT = float(1 << 53)
_WIDE = pa.list_(pa.decimal128(38, 0))


class Whitening(NamedTuple):
    """A fitted transform. ``directions`` has a column per component."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: list[float]
    identity_error: float


def as_longs(df: DataFrame, vector: str, name: str) -> DataFrame:
    """The rows whose vector counts, with ``floor(256 * entry)`` as array<bigint>."""
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    entries = F.col(vector).cast("array<double>")
    counts = F.col(vector).isNotNull() & F.forall(entries, lambda c: F.coalesce(good(c), F.lit(False)))
    return df.filter(counts).withColumn(name, F.transform(entries, lambda c: F.floor(c * SCALE).cast("bigint")))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)


def _added(rows: DataFrame, make) -> list:
    """Sum, entry by entry, of the lists that ``make`` gives for the matrices of each task."""

    def run(batches):
        total = None
        for x in _matrices(batches):
            part = make(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[Decimal(int(v)) for v in total]], _WIDE)], names=["sums"])

    lists = rows.mapInArrow(run, "sums array<decimal(38,0)>")
    summed = lists.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    found = {r["at"]: int(r["v"]) for r in summed.collect()}  # dimension squared at most
    return [found[k] for k in range(len(found))]


def products(y: np.ndarray) -> np.ndarray:
    """Upper triangle of y' y for whole numbers, exact: by doubles as long as they hold every sum."""
    largest = float(np.abs(y).max(initial=0)) ** 2
    rows = int(_EXACT // largest) if largest else len(y)
    upper = np.triu_indices(y.shape[1])
    if rows < 1:
        return (y.astype(object).T @ y.astype(object))[upper]
    total = np.zeros(len(upper[0]), object)
    for at in range(0, len(y), max(1, rows)):
        part = y[at : at + rows].astype(float)
        total = total + (part.T @ part)[upper].astype(np.int64).astype(object)
    return total


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with ``matrix[order][:, order] = L L'``; as many columns as the matrix has rank."""
    a, d = matrix.copy(), len(matrix)
    factor, order = np.zeros((d, d)), np.arange(d)
    floor = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        best = k + int(np.argmax(a.diagonal()[k:]))
        for m in (a, factor, order):
            m[[k, best]] = m[[best, k]]
        a[:, [k, best]] = a[:, [best, k]]
        pivot = a[k, k]
        if pivot <= floor:
            return factor[:, :k], order
        factor[k, k] = np.sqrt(pivot)
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs below n, in rounds whose pairs have no member in common."""
    ring = [*range(n), -1][: n + n % 2]
    for _ in range(len(ring) - 1):
        pairs = [(ring[i], ring[-1 - i]) for i in range(len(ring) // 2)]
        p, q = zip(*[(min(x), max(x)) for x in pairs if -1 not in x])
        yield np.array(p), np.array(q)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal."""
    a = factor.copy()
    small = np.finfo(float).eps
    for _ in range(SWEEPS if a.shape[1] > 1 else 0):
        largest = 0.0
        for p, q in _rounds(a.shape[1]):
            u, v = a[:, p], a[:, q]
            uu, vv, uv = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            scale = np.sqrt(uu * vv)
            turn = np.abs(uv) > small * scale
            largest = max(largest, float((np.abs(uv[turn]) / scale[turn]).max(initial=0.0)))
            zeta = (vv - uu) / np.where(turn, 2 * uv, 1.0)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * (u - t * v), c * (t * u + v)
        if largest <= 8 * small:
            break
    return a


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(0)
    falling = np.argsort(-values, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned / np.sqrt(values)
    vectors = vectors[:, falling]
    if vectors.size:
        largest = np.abs(vectors).argmax(0)
        vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return values[falling], vectors


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on every distinct integer vector of the table."""
    ship(df.sparkSession)
    distinct = materialise(as_longs(df.select(vector), vector, "_x").select(F.col("_x").alias("x")).distinct(), "fit-list")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "d").first()
    if most is None or not most["d"]:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), [], 0.0)
    n, d = most["n"], most["d"]
    rows = distinct.filter(F.size("x") == d)
    sums = _added(rows, lambda x: x.sum(0).astype(object))
    middle = [round(Fraction(s, n)) for s in sums]
    centre = np.array(middle, np.int64)
    flat = _added(rows, lambda x: products(x - centre))
    rest = [s - n * m for s, m in zip(sums, middle)]
    # n * sum(y y') - rest rest' is n^2 times the covariance, in whole numbers; / rounds once.
    covariance = np.zeros((d, d))
    trace = 0
    for v, i, j in zip(flat, *np.triu_indices(d)):
        exact = n * v - rest[i] * rest[j]
        covariance[i, j] = covariance[j, i] = exact / (n * n)
        trace += exact if i == j else 0
    values, vectors = eigenpairs(covariance)
    values, vectors = values[:components], vectors[:, :components]
    explained = [float(v / (trace / (n * n))) for v in values]
    model = Whitening(n, sums, values, vectors, explained, 0.0)
    return model._replace(identity_error=_identity_error(rows, model))


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return (x - mean) @ (model.directions / np.sqrt(model.values))


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured on the rows."""
    k = len(model.values)
    if not k:
        return 0.0

    def run(batches):
        total = np.zeros((k, k))
        for x in _matrices(batches):
            w = whitened(x, model)  # centred: the mean is taken off before
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

    sums = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    found = {r["at"]: r["v"] for r in sums.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    covariance = np.array([found[i] for i in range(k * k)]).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None beyond 64 bits."""
    largest = n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, sums), default=0)
    if largest**2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = (((x.astype(object) * n - np.array(sums, object)) ** 2)).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def transform(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The rows that take part, with ``deviation`` and ``whitened`` (array<double>, a component each)."""
    ship(df.sparkSession)
    longs, both = fresh_name(df, "_longs"), fresh_name(df, "_both")
    names = fresh_name(df, "deviation"), fresh_name(df, "whitened")

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def project(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, len(model.sums)), np.int64)
        flat = whitened(rows, model)
        ends = pa.array(np.arange(len(rows) + 1) * flat.shape[1], pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(deviations(rows, model.n, model.sums), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))],
            names=["deviation", "whitened"],
        )

    rows = as_longs(df, vector, longs).filter(F.size(longs) == len(model.sums)).filter(F.lit(model.n > 0))
    projected = rows.withColumn(both, project(F.col(longs)))
    return projected.select(
        *df.columns, F.col(f"{both}.deviation").alias(names[0]), F.col(f"{both}.whitened").alias(names[1])
    )
