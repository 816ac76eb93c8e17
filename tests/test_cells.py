"""Cell ids against a slow walk down the curve."""
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions.cells import PARTS, TURNS, cell_id, cluster_by_cell, inside, level_of, parent
from tidewater.session import scratch_path


def signed(v):
    return v - 2**64 if v >= 2**63 else v


def slow(lon, lat, level=30):
    a, b = math.radians(lon), math.radians(lat)
    p = (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))
    axis = max(range(3), key=lambda k: (abs(p[k]), -k))
    # Right-handed faces: the two other axes in turn, with their signs.
    sides = {0: (1, 2), 1: (-1, 2), 2: (-1, -2), 3: (2, 1), 4: (2, -1), 5: (-2, -1)}
    face = axis + 3 * (p[axis] < 0)
    other = {0: (1, 2), 1: (0, 2), 2: (0, 1), 3: (2, 1), 4: (2, 0), 5: (1, 0)}[face]
    sign = [1 if s > 0 else -1 for s in sides[face]]
    ij = []
    for k, s in zip(other, sign):
        c = s * p[k] / p[axis]
        c = 0.5 * math.sqrt(1 + 3 * c) if c >= 0 else 1 - 0.5 * math.sqrt(1 - 3 * c)
        ij.append(max(0, min(2**30 - 1, math.floor(c * 2**30))))
    turn, place = face & 1, 0
    for bit in range(29, 29 - level, -1):
        part = PARTS[turn].index((ij[0] >> bit & 1) * 2 + (ij[1] >> bit & 1))
        place, turn = place * 4 + part, turn ^ TURNS[part]
    return signed((face << 61) + (place << 61 - 2 * level) + (1 << 60 - 2 * level))


@pytest.fixture(scope="module")
def places(spark):
    draw = random.Random(3)
    rows = [(draw.uniform(-180, 180), math.degrees(math.asin(draw.uniform(-1, 1)))) for _ in range(400)]
    rows += [(0.0, 0.0), (180.0, 0.0), (-180.0, 0.0), (90.0, 0.0), (-90.0, 0.0), (0.0, 90.0), (0.0, -90.0)]
    return spark.createDataFrame(rows, "lon double, lat double")


@pytest.mark.parametrize("level", [0, 1, 7, 29, 30])
def test_cell_ids(places, level):
    got = places.select("lon", "lat", cell_id(F.col("lon"), F.col("lat"), level).alias("c"), level_of(cell_id(F.col("lon"), F.col("lat"), level)).alias("l"))
    for r in got.collect():
        assert r["c"] == slow(r["lon"], r["lat"], level) and r["l"] == level


def test_known_id_and_nulls(spark):
    at = lambda lon, lat: spark.range(1).select(cell_id(F.lit(lon).cast("double"), F.lit(lat).cast("double")).alias("c")).first()["c"]
    assert at(0.0, 0.0) == 0x1000000000000001  # the middle of the first face
    assert at(None, 0.0) is None and at(0.0, None) is None
    with pytest.raises(ValueError):
        cell_id(F.lit(0.0), F.lit(0.0), 31)


def test_cells_nest(places):
    leaf = cell_id(F.col("lon"), F.col("lat"))
    rows = places.select(leaf.alias("leaf"), *[parent(leaf, k).alias(f"p{k}") for k in (3, 8, 20)]).collect()
    for r in rows:
        for k in (3, 8, 20):
            reach = (1 << 2 * (30 - k)) - 1
            assert r[f"p{k}"] - reach <= r["leaf"] <= r[f"p{k}"] + reach
    some = rows[5]["p3"]
    got = places.filter(inside(leaf, some, 3)).count()
    assert got == sum(r["p3"] == some for r in rows)


def test_near_places_have_near_ids_and_ranges_are_pushed_down(spark, places):
    path = scratch_path(spark, "by-cell")
    cluster_by_cell(places, "lon", "lat", path, files=6)
    table = spark.read.parquet(path)
    edges = table.groupBy(F.input_file_name()).agg(F.min("cell").alias("a"), F.max("cell").alias("b")).orderBy("a").collect()
    assert len(edges) > 3 and all(x["b"] < y["a"] for x, y in zip(edges, edges[1:]))
    one = table.select(parent(F.col("cell"), 2).alias("p")).first()["p"]
    scan = table.filter(inside(F.col("cell"), one, 2))
    assert scan.count() == table.filter(parent(F.col("cell"), 2) == one).count() > 0
    assert "GreaterThanOrEqual(cell" in scan._jdf.queryExecution().executedPlan().toString()
