"""The farthest pair of two groups of points on a sphere.

Branch and bound on a tree of cells, for all pairs of groups at once. Cells of
the unit sphere hold the box their points fill. For a pair of cells the corners
farthest apart bound every distance from above, and two of their points give one
that is reached. Pairs that cannot beat the best reached distance of their
groups go; the others are looked at by cells half the size, until what is left
is few points to compare. Far points lie on the rims of two groups, so what is
left does not grow with their product.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.spatial import AXES, CELL, _square, metres_of, unit_vector
from tidewater.session import materialise

# Cells are 2 / 2^level wide; the first level has at most 152 that meet the sphere, the last ones are 6 m wide.
FIRST_LEVEL, LAST_LEVEL = 2, 21
# Point pairs left to compare for each point there is, above which cells are halved again.
PAIRS_PER_POINT = 8


def _cells(places: DataFrame, level: int, side: str) -> DataFrame:
    """Group, cell, number of places, box and one place of each occupied cell, columns marked by ``side``."""
    size = 2.0 / (1 << level)
    at = [F.floor(F.col(v) / size).cast("int").alias(f"{side}{c}") for v, c in zip(AXES, CELL)]
    box = [f(v).alias(f"{side}{n}{v}") for v in AXES for n, f in (("lo", F.min), ("hi", F.max))]
    one = [F.min_by(v, "loc").alias(f"{side}{v}") for v in AXES]
    return places.groupBy(F.col("g").alias(f"{side}g"), *at).agg(F.count(F.lit(1)).alias(f"{side}n"), *box, *one)


def _farthest_corners() -> Column:
    """Squared distance of the corners farthest apart of two boxes."""
    reach = [F.greatest(F.col(f"ahi{v}") - F.col(f"blo{v}"), F.col(f"bhi{v}") - F.col(f"alo{v}")) for v in AXES]
    return reduce(lambda s, t: s + t, [r * r for r in reach])


def _promising(pairs: DataFrame) -> DataFrame:
    """Cell pairs that may hold a pair of points as far apart as the best one seen of their groups."""
    bounded = materialise(pairs.withColumns({"_most": _farthest_corners(), "_reached": _square("a", "b")}), "cell-pairs")
    best = bounded.groupBy("ag", "bg").agg(F.max("_reached").alias("_best"))
    slack = 1e-12  # rounding of either side
    kept = bounded.join(best, ["ag", "bg"]).filter(F.col("_most") >= F.col("_best") - slack)
    return kept.select("ag", "bg", *[f"{s}{c}" for s in "ab" for c in CELL], "an", "bn")


def farthest_pairs(points: DataFrame, pairs: DataFrame, key: str, group: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """For each pair of groups (``pairs``: columns a, b) the largest distance of a point of a to one of b.

    Returns a, b, metres and the smallest keys at the two places, ``a_key`` and
    ``b_key``. Groups without points, or with NULL coordinates only, give no
    row. A group may be paired with itself.
    """
    known = points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull() & F.col(group).isNotNull())
    places = known.groupBy(F.col(group).alias("g"), F.col(lon).alias("lon"), F.col(lat).alias("lat")).agg(F.min(key).alias("loc"))
    places = materialise(places.withColumns(unit_vector(F.col("lon"), F.col("lat"))), "places")
    n, level = places.count(), FIRST_LEVEL
    asked = pairs.select(F.col("a").alias("ag"), F.col("b").alias("bg")).distinct()
    left = _promising(asked.join(_cells(places, level, "a"), "ag").join(_cells(places, level, "b"), "bg"))
    while level < LAST_LEVEL:
        work = left.agg(F.sum(F.col("an").cast("double") * F.col("bn"))).first()[0] or 0.0
        if work <= PAIRS_PER_POINT * n:
            break
        level += 1
        halves = left.drop("an", "bn")
        for side in "ab":
            parts = _cells(places, level, side)
            parent = [F.shiftright(f"{side}{c}", 1).alias(f"{side}{c}_") for c in CELL]
            parts = parts.select(*[c for c in parts.columns], *parent)
            halves = halves.withColumnsRenamed({f"{side}{c}": f"{side}{c}_" for c in CELL})
            halves = halves.join(parts, [f"{side}g", *[f"{side}{c}_" for c in CELL]]).drop(*[f"{side}{c}_" for c in CELL])
        left = _promising(halves)
    size = 2.0 / (1 << level)

    def members(side: str) -> DataFrame:
        at = [F.floor(F.col(v) / size).cast("int").alias(f"{side}{c}") for v, c in zip(AXES, CELL)]
        own = [F.col(v).alias(f"{side}{v}") for v in AXES]
        return places.select(F.col("g").alias(f"{side}g"), *at, *own, F.col("loc").alias(f"{side}_key"))

    met = left.drop("an", "bn")
    for side in "ab":
        met = met.join(members(side), [f"{side}g", *[f"{side}{c}" for c in CELL]])
    far = met.withColumn("_d", _square("a", "b"))
    # The smallest keys of equally far pairs.
    best = far.groupBy("ag", "bg").agg(F.min(F.struct((-F.col("_d")).alias("d"), "a_key", "b_key")).alias("m"))
    return best.select(
        F.col("ag").alias("a"), F.col("bg").alias("b"), metres_of(-F.col("m.d")).alias("metres"), "m.a_key", "m.b_key"
    )
