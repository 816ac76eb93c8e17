"""Two inequalities and containment against comparing every pair."""
import datetime as dt
import math
import operator
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators.inequality import count_matches, order_keys, weight_at_least
from tidewater.operators.ranges import container_counts, containers

OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
SCHEMA = "id long, x double, y long, _ox string, w int, block int"


def rows_of(seed, n):
    """A third of the rows share one x, a few are NULL or NaN, values tie."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        x = draw.choice([5.0, draw.choice([None, math.nan, math.inf, -math.inf, -0.0, 0.0]), draw.randint(0, 9) + 0.5, draw.random() * 10])
        out.append((i, x, draw.choice([None, draw.randint(-4, 4), draw.randint(-400, 400)]), "o", 1, 2))
    return out + out[:20]


def above_all(v):
    """Spark's order of doubles: NaN is the largest."""
    return (1, 0.0) if isinstance(v, float) and math.isnan(v) else (0, v)


@pytest.mark.parametrize("x_is, y_is", [("<", ">"), ("<=", ">"), (">", "<="), (">=", ">="), ("<", "<"), ("<=", "<=")])
@pytest.mark.parametrize("block_rows, max_rows", [(20, 30), (1000, 10_000)])
def test_count_matches(spark, x_is, y_is, block_rows, max_rows):
    left, right = rows_of(1, 150), rows_of(2, 170)
    a, b = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA)
    got = count_matches(a, b, ("x", x_is, "x"), ("y", y_is, "y"), "n", block_rows, max_rows)
    assert got.columns == [*a.columns, "n"]
    meets = lambda v, how, o: v is not None and o is not None and OPS[how](above_all(v), above_all(o))
    want = sorted((r[0], sum(meets(r[1], x_is, o[1]) and meets(r[2], y_is, o[2]) for o in right)) for r in left)
    assert sorted((r["id"], r["n"]) for r in got.collect()) == want


def test_times_and_empty_sides(spark):
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    rows = [(day(k % 7), dt.datetime(2024, 1, 1, k % 5)) for k in range(60)]
    df = spark.createDataFrame(rows, "d date, t timestamp_ntz")
    for r in count_matches(df, df, ("d", "<", "d"), ("t", ">=", "t"), "n", block_rows=9).collect():
        assert r["n"] == sum(r["d"] < d and r["t"] >= t for d, t in rows)
    none = df.limit(0)
    assert {r["n"] for r in count_matches(df, none, ("d", "<", "d"), ("t", ">", "t"), "n").collect()} == {0}
    assert count_matches(none, df, ("d", "<", "d"), ("t", ">", "t"), "n").count() == 0
    with pytest.raises(TypeError):
        count_matches(df.withColumn("s", F.lit("a")), df, ("s", "<", "d"), ("t", ">", "t"))
    with pytest.raises(TypeError):
        count_matches(df, df.withColumn("x", F.lit(1.0)), ("d", "<", "x"), ("t", ">", "t"))


def test_no_pair_is_built(spark):
    df = spark.createDataFrame(rows_of(3, 100), SCHEMA)
    plan = count_matches(df, df, ("x", "<", "x"), ("y", ">", "y"), "n", 30)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_order_keys():
    values = np.array([-math.inf, -2.5, -1e-300, -0.0, 1e-300, 3.0, math.inf, math.nan])
    keys = order_keys(values, False)
    assert (np.diff(keys) > 0).all() and order_keys(np.array([0.0]), False) == keys[3]
    assert (np.diff(order_keys(values, True)) < 0).all()
    ends = np.array([-(2**63), -1, 0, 2**63 - 1])
    assert (np.diff(order_keys(ends, True)) < 0).all()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 64, 300])
def test_weight_at_least(n):
    draw = np.random.default_rng(n)
    ranks, weights = draw.permutation(n), draw.integers(1, 9, n)
    first, least = draw.integers(0, n + 1, 50), draw.integers(0, n + 1, 50)
    want = [int(weights[a:][ranks[a:] >= r].sum()) for a, r in zip(first, least)]
    assert weight_at_least(ranks, weights, first, least).tolist() == want


@pytest.mark.parametrize("max_rows", [15, 10_000])
@pytest.mark.parametrize("within", [[], ["g"]])
def test_containers(spark, within, max_rows):
    draw = random.Random(9)
    at = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k)

    def ranges(n, length):
        out = []
        for i in range(n):
            start = draw.choice([None, draw.randint(0, 300), 100, 100])
            end = None if draw.random() < 0.1 else at((start or 0) + draw.randint(1, length))
            out.append((i, draw.choice(["a", "b", None]), None if start is None else at(start), end))
        return out

    schema = "id long, g string, start timestamp_ntz, end timestamp_ntz"
    left, right = ranges(90, 40), ranges(60, 120)
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    low = lambda t: t or dt.datetime.min
    high = lambda t: t or dt.datetime.max
    holds = lambda o, r: low(o[2]) <= low(r[2]) and high(r[3]) <= high(o[3])
    found = {r["id"]: r["container"] for r in containers(a, b, "start", "end", "id", within=within, max_rows=max_rows).collect()}
    assert len(found) == len(left)
    for r in left:
        inside = [(high(o[3]), o[0]) for o in right if holds(o, r) and (not within or o[1] == r[1])]
        assert found[r[0]] == (max(inside)[1] if inside else None)
    if not within:
        counts = {r["id"]: r["n_containers"] for r in container_counts(a, b, "start", "end", max_rows=max_rows).collect()}
        assert counts == {r[0]: sum(holds(o, r) for o in right) for r in left}
