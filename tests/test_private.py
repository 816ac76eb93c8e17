"""Contribution bounds, thresholds and noise."""
import json
import math

import pytest
from pyspark.sql import functions as F

from tidewater.operators.private import Bounds, laplace, private_aggregate, private_quantiles


@pytest.fixture(scope="module")
def visits(spark):
    rows = [(u, f"g{u % 4}", 10.0) for u in range(40)]
    rows += [(999, f"g{i % 4}", 1_000_000.0) for i in range(5000)]  # one user with nearly all rows
    rows += [(7, "rare", 5.0)]
    return spark.createDataFrame(rows, "user long, grp string, v double")


def test_one_user_has_bounded_influence(visits):
    out = private_aggregate(visits, "user", ["grp"], "v", Bounds(max_groups=2, high=20.0, max_count=3, min_users=2), {"median": 0.5})
    got = {r["grp"]: r for r in out.collect()}
    assert set(got) == {"g0", "g1", "g2", "g3"}  # the group of one user is held back
    assert sum(r["n_users"] for r in got.values()) in (41, 42)
    assert all(r["anon_sum"] <= 10 * 10 + 20 and r["anon_count"] <= 10 + 3 for r in got.values())
    assert all(r["median"] == 10.0 and r["anon_avg"] <= 11 for r in got.values())
    assert json.loads(got["g0"]["report"])["bounds"] == {"low": 0.0, "high": 20.0}


def test_noise_is_repeatable_and_depends_on_the_seed(visits):
    run = lambda seed: sorted(
        tuple(r)
        for r in private_aggregate(visits, "user", ["grp"], "v", Bounds(epsilon=5.0, seed=seed, min_users=0)).drop("report").collect()
    )
    assert run("a") == run("a")
    assert run("a") != run("b")


def test_laplace_has_the_right_spread(spark):
    noise = spark.range(20_000).select(laplace(2.0, "s", F.col("id")).alias("x"))
    row = noise.agg(F.avg("x").alias("m"), F.avg(F.abs("x")).alias("a"), F.var_pop("x").alias("v")).first()
    assert abs(row["m"]) < 0.1 and abs(row["a"] - 2.0) < 0.1 and abs(row["v"] - 8.0) < 0.8


def test_quantiles_follow_the_exponential_mechanism(spark):
    """4,000 groups of the same six values: how often each stretch is drawn, against the weights."""
    values, low, high, epsilon = [1.0, 2.0, 2.0, 5.0, 6.0, 9.0], 0.0, 10.0, 1.0
    units = spark.range(4000).select(F.col("id").alias("g"), F.explode(F.array(*[F.lit(v) for v in values])).alias("v"))
    got = [r["q"] for r in private_quantiles(units, ["g"], "v", {"q": 0.5}, low, high, epsilon, "seed").collect()]
    assert len(got) == 4000
    edges = [low, *sorted(set(values)), high]
    weights = [(b - a) * math.exp(-epsilon / 2 * abs(sum(v <= a for v in values) - 3)) for a, b in zip(edges, edges[1:])]
    for a, b, w in zip(edges, edges[1:], weights):
        inside = [x for x in got if a <= x < b]
        want = w / sum(weights)
        assert abs(len(inside) / 4000 - want) < 4 * math.sqrt(want * (1 - want) / 4000)
        assert abs(sum(inside) / len(inside) - (a + b) / 2) < 0.1 * (b - a)  # evenly within it


def test_quantiles_do_not_depend_on_how_wide_the_bounds_are(spark):
    units = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") / 30).alias("v"))
    for seed in ("a", "b", "c", "d"):
        for high in (100.0, 1e6):
            r = private_quantiles(units, ["g"], "v", {"p10": 0.1, "median": 0.5}, 0.0, high, 1.0, seed).first()
            assert abs(r["p10"] - 10) < 2 and abs(r["median"] - 50) < 2


def test_private_quantiles_of_odd_groups(spark):
    rows = [("one", 3.0), ("out", 99.0), ("same", 5.0), ("same", 5.0), (None, 1.0), (None, 2.0), ("null", None)]
    units = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["q"] for r in private_quantiles(units, ["g"], "v", {"q": 0.5}, 0.0, 10.0, 2.0, "s").collect()}
    assert set(got) == {"one", "out", "same", None} and all(0.0 <= q <= 10.0 for q in got.values())
    fixed = private_quantiles(units.filter("g = 'same'"), ["g"], "v", {"q": 0.5}, 5.0, 5.0, 2.0, "s").first()
    assert fixed["q"] == 5.0


def test_noise_off_is_exact_and_noise_on_is_near(visits):
    run = lambda **more: {
        r["grp"]: r["median"] for r in private_aggregate(visits, "user", ["grp"], "v", Bounds(high=20.0, min_users=2, **more), {"median": 0.5}).collect()
    }
    assert all(m == 10.0 for m in run().values())
    noisy = run(epsilon=500.0, seed="x")
    assert all(abs(m - 10.0) < 1.5 for m in noisy.values() if m is not None)
