"""Farthest pairs against comparing every pair."""
import math
import random

import pytest

from tidewater.operators import farthest
from tidewater.operators.farthest import farthest_pairs

SCHEMA = "id long, g string, lon double, lat double"


def metres(p, q):
    u, v = ([math.cos(y) * math.cos(x), math.cos(y) * math.sin(x), math.sin(y)] for x, y in ((math.radians(a), math.radians(b)) for a, b in (p, q)))
    return 2 * 6371010.0 * math.asin(min(1.0, math.dist(u, v) / 2))


@pytest.fixture(scope="module")
def points():
    draw = random.Random(12)
    out = []
    for g, (lon, lat, spread) in {"a": (10, 20, 5), "b": (12, 21, 8), "c": (0, 0, 90), "d": (-179, 80, 0.01)}.items():
        out += [(g, lon + draw.gauss(0, spread), max(-90.0, min(90.0, lat + draw.gauss(0, spread / 2)))) for _ in range(150)]
    out += [("e", 5.0, 5.0)] * 40 + [("a", None, 1.0), (None, 1.0, 1.0), ("empty", None, None)]
    return [(i, *p) for i, p in enumerate(out)]


@pytest.mark.parametrize("per_point", [0.05, 8])
def test_farthest_pairs(spark, points, per_point, monkeypatch):
    monkeypatch.setattr(farthest, "PAIRS_PER_POINT", per_point)
    names = ["a", "b", "c", "d", "e", "empty", "none"]
    wanted = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    pairs = spark.createDataFrame(wanted + wanted[:3], "a string, b string")
    got = {(r["a"], r["b"]): r for r in farthest_pairs(spark.createDataFrame(points, SCHEMA), pairs, "id", "g").collect()}
    by = {n: [p for p in points if p[1] == n and None not in p] for n in names}
    assert set(got) == {(x, y) for x, y in wanted if by[x] and by[y]}
    for (x, y), r in got.items():
        most = max(metres(p[2:], q[2:]) for p in by[x] for q in by[y])
        assert r["metres"] == pytest.approx(most, abs=1e-3)
        ends = {p[0]: p for p in points}
        assert metres(ends[r["a_key"]][2:], ends[r["b_key"]][2:]) == pytest.approx(most, abs=1e-3)


def test_work_grows_with_the_points_not_the_pairs(spark, monkeypatch):
    """Twice the points of two clouds leave about twice the pairs of points to compare, not four times."""
    seen = []
    for n in (500, 2000):
        draw = random.Random(n)
        rows = [(i, "ab"[i % 2], draw.gauss(i % 2 * 30, 9), draw.gauss(0, 9)) for i in range(n)]
        kept = []
        promising = farthest._promising
        monkeypatch.setattr(farthest, "_promising", lambda p: kept.append(promising(p)) or kept[-1])
        pairs = spark.createDataFrame([("a", "b")], "a string, b string")
        farthest_pairs(spark.createDataFrame(rows, SCHEMA), pairs, "id", "g").collect()
        monkeypatch.setattr(farthest, "_promising", promising)
        seen.append(kept[-1].selectExpr("sum(an * bn)").first()[0])
    assert seen[1] <= max(8 * 2000, 6 * seen[0])
