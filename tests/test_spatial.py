"""Spatial operators against brute force on small fixtures with copies, dense spots, poles and the date line."""
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import spatial
from tidewater.operators.clusters import components, density_cluster
from tidewater.operators.spatial import (
    EARTH_RADIUS,
    geohash,
    haversine,
    locations,
    nearest_neighbours,
    neighbour_counts,
    proximity_join,
)


def metres(a, b):
    (lon1, lat1), (lon2, lat2) = a, b
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS * math.asin(min(math.sqrt(h), 1.0))


@pytest.fixture(scope="module")
def data():
    """240 points: a third copies of one place, a dense spot, the poles, the date line, and scattered ones."""
    rng = random.Random(11)
    out = [(10.0, 10.0)] * 80
    out += [(10.0 + rng.gauss(0, 0.02), 10.0 + rng.gauss(0, 0.02)) for _ in range(60)]
    out += [(rng.uniform(-180, 180), 89.5 + rng.uniform(0, 0.5)) for _ in range(20)]
    out += [(rng.choice([179.9, -179.9]) + rng.uniform(-0.05, 0.05), rng.uniform(-1, 1)) for _ in range(30)]
    out += [(rng.uniform(-180, 180), rng.uniform(-80, 80)) for _ in range(50)]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def points(spark, data):
    return spark.createDataFrame([(i, *p) for i, p in data], "id bigint, lon double, lat double").repartition(4).cache()


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 90.0, 0.0), (179.0, 10.0, -179.0, 10.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine(*[F.col(c) for c in "abcd"])).collect()]
    assert got == pytest.approx([math.pi / 2 * EARTH_RADIUS, metres((179.0, 10.0), (-179.0, 10.0))])


@pytest.mark.parametrize("max_rows", [5, 1_000_000])
def test_proximity_join(points, data, max_rows):
    radius = 20_000.0
    left, right = points.filter("id % 2 = 0"), points.filter("id % 2 = 1")
    got = proximity_join(locations(left, "id"), locations(right, "id"), radius, max_rows)

    def places(parity):
        out = {}
        for i, p in data:
            if i % 2 == parity:
                out.setdefault(p, []).append(i)
        return {p: (min(ids), len(ids)) for p, ids in out.items()}

    want = sorted(
        (la, lb, na, nb)
        for pa, (la, na) in places(0).items()
        for pb, (lb, nb) in places(1).items()
        if metres(pa, pb) <= radius
    )
    assert sorted((r["left_loc"], r["right_loc"], r["left_n"], r["right_n"]) for r in got.collect()) == want


@pytest.mark.parametrize("leaf", [2, 64])
def test_neighbour_counts(points, data, leaf):
    radius = 30_000.0
    locs = locations(points, "id")
    got = {r["loc"]: r["n_near"] for r in neighbour_counts(locs, radius, leaf).collect()}
    want = {i: sum(metres(p, q) <= radius for _, q in data) for i, p in data if i in got}
    assert got == want
    assert len(got) == len({p for _, p in data})


@pytest.mark.parametrize("leaf", [2, 64])
def test_nearest_neighbours(points, data, leaf, monkeypatch):
    monkeypatch.setattr(spatial, "LEAF_LOCATIONS", leaf)
    k = 4
    got = {}
    for r in nearest_neighbours(points, "id", k).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"], r["metres"]))
    assert len(got) == len(data)
    for i, p in data:
        near = sorted((round(metres(p, q), 6), j) for j, q in data if j != i)[:k]
        mine = [(round(m, 3), j) for _, j, m in sorted(got[i])]
        assert [m for m, _ in mine] == pytest.approx([m for m, _ in near], abs=0.01)
        if len({round(m, 2) for m, _ in near}) == k or near[-1][0] == 0.0:
            assert [j for _, j in mine] == [j for _, j in near]


def brute_clusters(data, eps, min_points):
    near = {i: [j for j, q in data if metres(p, q) <= eps] for i, p in data}
    core = {i for i in near if len(near[i]) >= min_points}
    root = {}
    for start in sorted(core):
        if start in root:
            continue
        stack = [start]
        while stack:
            i = stack.pop()
            if i not in root:
                root[i] = start
                stack.extend(j for j in near[i] if j in core)
    out = {}
    for i, _ in data:
        mine = [root[i]] if i in core else [root[j] for j in near[i] if j in core]
        out[i] = (min(mine) if mine else None, i in core)
    return out


@pytest.mark.parametrize("eps,min_points", [(1_500.0, 4), (30_000.0, 5), (300_000.0, 3)])
def test_density_cluster(points, data, eps, min_points):
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in density_cluster(points, "id", eps, min_points, max_rows=25).collect()}
    assert got == brute_clusters(data, eps, min_points)


def test_density_cluster_dense_neighbours(spark):
    """Two dense blobs side by side, once just within reach of each other and once just out of it."""
    rng = random.Random(2)
    degree = math.radians(1) * EARTH_RADIUS
    for gap, n_clusters in ((0.0099, 1), (0.0103, 2)):
        left = [(-rng.uniform(0, 0.004), rng.uniform(0, 0.02)) for _ in range(120)] + [(0.0, 0.01)]
        right = [(gap + rng.uniform(0.0004, 0.004), rng.uniform(0, 0.02)) for _ in range(120)] + [(gap, 0.01)]
        data = list(enumerate(left + right))
        points = spark.createDataFrame([(i, *p) for i, p in data], "id bigint, lon double, lat double")
        eps = 0.0101 * degree
        got = {r["id"]: (r["cluster"], r["is_core"]) for r in density_cluster(points, "id", eps, 4).collect()}
        assert got == brute_clusters(data, eps, 4)
        assert len({c for c, _ in got.values() if c is not None}) >= n_clusters


def test_density_cluster_settles_at_one_metre(spark, monkeypatch):
    """Two dense groups a little out of reach: few levels decide, as at any other distance."""
    from tidewater.operators import clusters

    monkeypatch.setattr(clusters, "MAX_LEVEL", 10)  # not settling by then is an error
    rng = random.Random(6)
    metre = 1 / (math.radians(1) * EARTH_RADIUS)  # in degrees, at the equator
    data = [(rng.uniform(0, 0.5) * metre, rng.uniform(0, 0.5) * metre) for _ in range(150)]
    data += [((1.6 + rng.uniform(0, 0.5)) * metre, rng.uniform(0, 0.5) * metre) for _ in range(150)]
    data = list(enumerate(data))
    points = spark.createDataFrame([(i, *p) for i, p in data], "id bigint, lon double, lat double")
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in density_cluster(points, "id", 1.0, 4).collect()}
    assert got == brute_clusters(data, 1.0, 4)
    assert {c for c, _ in got.values()} == {0, 150}


def test_components_long_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 560)]
    nodes = spark.createDataFrame([(i,) for i in [*range(100, 161), *range(500, 560), 7]], "id bigint")
    edges = spark.createDataFrame(chain + hub, "u bigint, v bigint")
    got = {r["id"]: r["root"] for r in components(nodes, edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 7: 7}


def test_geohash_known_values(spark):
    df = spark.createDataFrame([(-5.6, 42.6), (10.40744, 57.64911)], "lon double, lat double")
    assert [r[0] for r in df.select(geohash(F.col("lon"), F.col("lat"), 5)).collect()] == ["ezs42", "u4pru"]
