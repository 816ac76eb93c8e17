"""Points in boxes against comparing every pair."""
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import spatial
from tidewater.operators.spatial import points_in_boxes

POINT, BOX = "id long, lon double, lat double, _x string", "box long, w double, s double, e double, n double"


def holds(box, point):
    (_, w, s, e, n), (_, lon, lat, _) = box, point
    if None in (w, s, e, n, lon, lat) or s > n or not s <= lat <= n:
        return False
    same = {lon, -lon} if abs(lon) == 180 else {lon}  # one meridian
    return any(w <= x <= e if w <= e else x >= w or x <= e for x in same)


@pytest.fixture(scope="module")
def globe():
    draw = random.Random(8)
    points = [(draw.uniform(-180, 180), draw.uniform(-90, 90)) for _ in range(200)]
    points += [(10.0, 20.0)] * 60 + [(180.0, 0.0), (-180.0, 0.0), (0.0, 90.0), (0.0, -90.0), (None, 1.0), (1.0, None)]
    boxes = []
    for _ in range(60):
        width, height = draw.choice([0, 0.001, 1, 40, 359]), draw.choice([0.001, 3, 100])
        w = draw.uniform(-180, 180)
        e = w + width
        boxes.append((w, draw.uniform(-90, 80), e if e <= 180 else e - 360, 0.0, height))
    boxes = [(w, s, e, min(90.0, s + h)) for w, s, e, _, h in boxes]
    boxes += [(-180.0, -90.0, 180.0, 90.0), (170.0, -10.0, 180.0, 10.0), (180.0, -1.0, 180.0, 1.0), (-180.0, -1.0, -180.0, 1.0),
              (10.0, 20.0, 10.0, 20.0), (180.0, -5.0, -170.0, 5.0), (0.0, 10.0, 1.0, 5.0), (None, 0.0, 1.0, 1.0)]
    return [(i, *p, "x") for i, p in enumerate(points)], [(i, *b) for i, b in enumerate(boxes)]


@pytest.mark.parametrize("max_rows", [10, 100_000])
def test_points_in_boxes(spark, globe, max_rows):
    points, boxes = globe
    a, b = spark.createDataFrame(points, POINT).repartition(3), spark.createDataFrame(boxes, BOX)
    got = points_in_boxes(a.drop("_x"), b, "lon", "lat", "w", "s", "e", "n", max_rows)
    assert got.columns == ["id", "lon", "lat", "box", "w", "s", "e", "n"]
    want = sorted((o[0], p[0]) for o in boxes for p in points if holds(o, p))
    assert sorted((r["box"], r["id"]) for r in got.collect()) == want


def test_boxes_are_copied_a_fixed_number_of_times(spark, globe):
    boxes = spark.createDataFrame(globe[1], BOX).filter("w <= e")
    for side, low, high in (("w", "w", "e"), ("s", "s", "n")):
        level = spatial._box_level(F.col(high) - F.col(low))
        cells = spatial._box_cell(F.col(high), level) - spatial._box_cell(F.col(low), level) + 1
        assert boxes.agg(F.max(cells).alias("n")).first()["n"] <= spatial.BOX_FAN + 1, side


def test_no_boxes_or_points(spark, globe):
    a, b = spark.createDataFrame(globe[0], POINT).drop("_x"), spark.createDataFrame(globe[1], BOX)
    args = ("lon", "lat", "w", "s", "e", "n")
    assert points_in_boxes(a, b.limit(0), *args).count() == 0
    assert points_in_boxes(a.limit(0), b, *args).count() == 0
