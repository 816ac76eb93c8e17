"""Whitening against numpy's own eigenvectors and whole-number arithmetic."""
import math
import random

import numpy as np
import pytest

import tidewater.llm.queries as registered
from tidewater.llm.whitening import deviations, eigenpairs, fit, pivoted_cholesky, products, transform

SCHEMA = "vec_id long, embedding array<double>, label int, Deviation string, whitened string, _longs int, _both int"


def longs(vector):
    return tuple(math.floor(256 * c) + 0 for c in vector)


@pytest.fixture(scope="module")
def vectors():
    draw = random.Random(11)
    base = [[draw.gauss(0, 3 / (1 + k)) + k for k in range(6)] for _ in range(200)]
    rows = [[a + 0.5 * b for a, b in zip(v, reversed(v))] for v in base]
    rows += rows[:30] + [rows[0]] * 100  # copies count once
    rows += [[c + 1e-4 for c in rows[5]], [-0.0] * 6, [0.0] * 6]  # the same whole numbers or not
    bad = [None, [1.0, None, 2.0, 3.0, 4.0, 5.0], [math.nan] + [0.0] * 5, [math.inf] * 6, [0.0] * 5 + [-math.inf]]
    return rows, bad + [[1e30] + [0.0] * 5, [], [1.0, 2.0], [1.0] * 7]


def frame(spark, rows):
    return spark.createDataFrame([(i if i % 7 else None, v, 1, "d", "w", 1, 2) for i, v in enumerate(rows)], SCHEMA).repartition(3)


def test_whitening_against_numpy(spark, vectors):
    good, bad = vectors
    table = frame(spark, good + bad)
    distinct = sorted({longs(v) for v in good})
    x = np.array(distinct, float)
    centred = x - x.mean(0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    values, directions = values[::-1][:4], directions[:, ::-1][:, :4]
    model = fit(table)
    assert model.n == len(distinct)
    assert model.sums == [sum(v[k] for v in distinct) for k in range(6)]
    assert model.values == pytest.approx(values, rel=1e-12)
    assert np.abs((model.directions * directions).sum(0)) == pytest.approx(np.ones(4), abs=1e-12)
    assert model.explained == pytest.approx(values / np.trace(centred.T @ centred / len(x)), rel=1e-12)
    assert 0 <= model.identity_error < 1e-10

    result = transform(table, model)
    assert result.columns == [*table.columns, "_deviation", "_whitened"]
    rows = result.collect()
    assert len(rows) == len(good)
    signs = np.sign((model.directions * directions).sum(0))
    for r in rows:
        own = longs(r["embedding"])
        assert r["_deviation"] == sum((model.n * a - s) ** 2 for a, s in zip(own, model.sums))
        want = (np.array(own) - x.mean(0)) @ directions / np.sqrt(values) * signs
        assert r["_whitened"] == pytest.approx(want, abs=1e-9)


def test_fit_does_not_depend_on_the_order(spark, vectors):
    one, two = fit(frame(spark, vectors[0])), fit(frame(spark, vectors[0][::-1]).repartition(7))
    assert one.sums == two.sums and (one.values == two.values).all() and (one.directions == two.directions).all()


@pytest.mark.parametrize(
    "rows, rank",
    [([], 0), ([None, [math.nan]], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([[1.0, 2.0], [3.0, 5.0]], 1), ([[]], 0),
     ([[float(i), 2.0 * i, 5.0] for i in range(9)], 1), ([[float(i), float(i * i), 0.0, 1.0, float(i**3)] for i in range(9)], 3)],
)
def test_few_vectors_and_low_rank(spark, rows, rank):
    table = frame(spark, rows)
    model = fit(table)
    assert len(model.values) == rank and len(model.explained) == rank
    assert all(len(r["_whitened"]) == rank for r in transform(table, model).collect())
    if rank:
        assert sum(model.explained) == pytest.approx(1.0)
        assert model.identity_error < 1e-9


def test_equal_eigenvalues(spark):
    corners = [[float(a), float(b), float(c)] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    model = fit(frame(spark, corners))
    assert model.values == pytest.approx([65536.0] * 3)
    assert model.identity_error < 1e-12


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (5, 3), (8, 8), (33, 20)])
def test_eigenpairs(d, rank):
    draw = np.random.default_rng(d)
    a = draw.normal(size=(rank, d)) * np.logspace(0, -5, d)
    matrix = a.T @ a
    values, vectors = eigenpairs(matrix)
    assert len(values) <= rank and (np.diff(values) <= 0).all()
    wanted = np.linalg.svd(a, compute_uv=False)[: len(values)] ** 2
    assert values[:3] == pytest.approx(wanted[:3], rel=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * values[0]
    factor, order = pivoted_cholesky(matrix)
    assert np.abs(factor @ factor.T - matrix[np.ix_(order, order)]).max() < 1e-13 * matrix.max()


@pytest.mark.parametrize("size", [3, 1 << 20, 1 << 27, 1 << 40])
def test_products_are_exact(size):
    draw = random.Random(size)
    y = np.array([[draw.randint(-size, size) for _ in range(3)] for _ in range(50)])
    exact = [sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for i in range(3) for j in range(i, 3)]
    assert [int(v) for v in products(y)] == exact


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 39, -5], [3, 4]])
    assert deviations(x, 3, [9, 12]) == [None, 0]
    assert deviations(x, 1, [0, 0]) == [None, 25]
    assert deviations(np.array([[1 << 31]]), 1, [0]) == [1 << 62]


def test_query(spark, sf_dir):
    rows = registered.QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    assert sorted({r["vec_id"] for r in rows}) == sorted(g["vec_id"] for g in given)
    x = {g["vec_id"]: longs(g["embedding"]) for g in given}
    distinct = np.array(sorted(set(x.values())), float)
    values, directions = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, directions = values[::-1], directions[:, ::-1]
    assert len(rows) == 4 * len(given)
    for r in rows:
        k = r["component"] - 1
        want = (np.array(x[r["vec_id"]]) - distinct.mean(0)) @ directions[:, k] / np.sqrt(values[k])
        assert abs(r["whitened"]) == pytest.approx(abs(want), abs=1e-8)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-10 and r["n"] == len(distinct)
