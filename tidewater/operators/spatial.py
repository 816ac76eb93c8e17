"""Points on a sphere: proximity joins, nearest neighbours, clusters, grids.

Longitude and latitude become a point on the unit sphere, so that one cubic
grid works everywhere, poles and date line included. Distances on the sphere
grow with straight-line (chord) distances, so grids and filters use chords.

Points at the same place are collapsed to one weighted location before any
pairing: many copies of a point cost no more than one.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.relational import rank_at_most
from tidewater.operators.skew import MAX_GROUP_ROWS, salted_join
from tidewater.session import materialise

# Fixed value: radius of the sphere in metres.
EARTH_RADIUS = 6371010.0
CELL = ["cx", "cy", "cz"]
AXES = ["x", "y", "z"]


def unit_vector(lon: Column, lat: Column) -> dict[str, Column]:
    lon, lat = F.radians(lon), F.radians(lat)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def chord_of(metres: float) -> float:
    """Straight-line distance on the unit sphere of two points ``metres`` apart along the surface."""
    return 2 * math.sin(min(metres / EARTH_RADIUS, math.pi) / 2)


def _square(a: str, b: str) -> Column:
    return reduce(lambda s, t: s + t, [(F.col(f"{a}{v}") - F.col(f"{b}{v}")) * (F.col(f"{a}{v}") - F.col(f"{b}{v}")) for v in AXES])


def metres_of(square: Column) -> Column:
    """Surface distance from a squared chord."""
    return 2 * EARTH_RADIUS * F.asin(F.least(F.sqrt(square) / 2, F.lit(1.0)))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Surface distance in metres."""
    half = lambda a, b: F.sin((F.radians(b) - F.radians(a)) / 2)
    dlat, dlon = half(lat1, lat2), half(lon1, lon2)
    inner = dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon
    return 2 * EARTH_RADIUS * F.asin(F.least(F.sqrt(inner), F.lit(1.0)))


def locations(points: DataFrame, key: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """One row per distinct place: smallest key, number of points, unit vector."""
    places = points.groupBy(lon, lat).agg(F.min(key).alias("loc"), F.count(F.lit(1)).alias("n"))
    return places.withColumns(unit_vector(F.col(lon), F.col(lat)))


def _cell(size: float) -> list[Column]:
    return [F.floor(F.col(v) / F.lit(size)).cast("bigint").alias(c) for v, c in zip(AXES, CELL)]


def _around(reach: int) -> Column:
    """Offsets of the cells up to ``reach`` steps away on each axis, as an array of structs."""
    return _grid(-reach, reach)


def _grid(low: int, high: int) -> Column:
    """All (i, j, k) with entries from ``low`` to ``high``."""
    steps = f"sequence({low}, {high})"
    return F.expr(
        f"flatten(transform({steps}, i -> flatten(transform({steps}, j -> "
        f"transform({steps}, k -> named_struct('i', i, 'j', j, 'k', k))))))"
    )


def _spread(df: DataFrame, reach: int) -> DataFrame:
    """Copy each row to its own and the neighbouring cells."""
    moved = df.withColumn("_o", F.explode(_around(reach)))
    return moved.withColumns({c: F.col(c) + F.col(f"_o.{o}") for c, o in zip(CELL, "ijk")}).drop("_o")


def touching_cells(a: DataFrame, b: DataFrame, reach: int) -> DataFrame:
    """(cell of a as acx.., cell of b as cx..) for used cells at most ``reach`` steps apart.

    Works on distinct cells, so its size does not depend on how full they are.
    """
    own = a.select(*CELL).distinct().select("*", *[F.col(c).alias(f"a{c}") for c in CELL])
    return _spread(own, reach).join(b.select(*CELL).distinct(), CELL)


def proximity_join(
    left: DataFrame, right: DataFrame, metres: float, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Pairs of locations at most ``metres`` apart: (left_loc, right_loc, left_n, right_n, metres).

    Cells are as wide as the radius, so partners lie in the same or a touching
    cell. Left rows are copied only to touching cells that the right side uses,
    joined on the cell, and filtered by distance.
    """
    chord = chord_of(metres)
    a = left.select(F.col("loc").alias("left_loc"), F.col("n").alias("left_n"), *[F.col(v).alias(f"l{v}") for v in AXES], *_cell(chord))
    b = right.select(F.col("loc").alias("right_loc"), F.col("n").alias("right_n"), *[F.col(v).alias(f"r{v}") for v in AXES], *_cell(chord))
    touching = touching_cells(a, b, 1)
    probes = a.withColumnsRenamed({c: f"a{c}" for c in CELL}).join(touching, [f"a{c}" for c in CELL])
    probes = probes.drop(*[f"a{c}" for c in CELL])
    pairs = salted_join(b, probes, CELL, salt_by=["right_loc"], max_rows=max_rows)
    square = _square("l", "r")
    near = pairs.filter(square <= F.lit(chord * chord))
    return near.select("left_loc", "right_loc", "left_n", "right_n", metres_of(square).alias("metres"))


def extent_centroid(points: DataFrame, keys: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Bounding box, number of points and centroid per group (the mean direction of the points)."""
    unit = points.withColumns(unit_vector(F.col(lon), F.col(lat)))
    exact = lambda c: F.col(c).cast("decimal(28,15)")  # sums that do not depend on row order
    sums = unit.groupBy(*keys).agg(
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"), F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
        F.count(F.lit(1)).alias("n"), *[F.sum(exact(v)).cast("double").alias(v) for v in AXES],
    )
    flat = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    return sums.select(
        *keys, "min_lon", "max_lon", "min_lat", "max_lat", "n",
        F.degrees(F.atan2("y", "x")).alias("centroid_lon"), F.degrees(F.atan2(F.col("z"), flat)).alias("centroid_lat"),
    )


def snap(c: Column, step: float) -> Column:
    """Number of the grid line at or below a coordinate."""
    return F.floor(c / F.lit(step)).cast("bigint")


# The geohash alphabet.
GEOHASH_LETTERS = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lon: Column, lat: Column, length: int) -> Column:
    """Geohash of a point: bits of longitude and latitude in turn, five to a letter."""
    bits = 5 * length
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    scaled = lambda c, low, span, n: F.least(F.floor((c - low) / span * (1 << n)), F.lit((1 << n) - 1)).cast("bigint")
    x, y = scaled(lon, -180.0, 360.0, lon_bits), scaled(lat, -90.0, 180.0, lat_bits)
    bit = lambda i: (
        F.shiftright(x, lon_bits - 1 - i // 2) if i % 2 == 0 else F.shiftright(y, lat_bits - 1 - i // 2)
    ).bitwiseAND(F.lit(1))
    letters = []
    for start in range(0, bits, 5):
        value = reduce(lambda s, t: s + t, [bit(start + j) * (16 >> j) for j in range(5)])
        letters.append(F.substr(F.lit(GEOHASH_LETTERS), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


# ---------------------------------------------------------------------------
# A tree of cells: counts per cell at every level, fine enough that no leaf
# holds more than a few locations. Queries walk it level by level, keeping for
# each point only the cells that can still matter.
# ---------------------------------------------------------------------------

LEAF_LOCATIONS = 16
MAX_LEVEL = 50  # doubles cannot tell points apart beyond this


def _cells_at(level: int) -> list[Column]:
    """Cell of a point at a level; level 0 cells are 2 wide and each level halves them."""
    scale = float(2**level)
    return [F.floor((F.col(v) + 1.0) / 2.0 * scale).cast("bigint").alias(c) for v, c in zip(AXES, CELL)]


def _parent(c: str) -> Column:
    return F.shiftright(F.col(c), 1).alias(c)


class CellTree:
    """Cell counts of weighted locations (columns loc, w, x, y, z).

    ``at(level)``  cells: number of locations, weight, tight box, is_leaf
    ``leaves``     every location with the level and cell of its leaf
    """

    def __init__(self, locs: DataFrame, leaf: int = LEAF_LOCATIONS):
        locs = materialise(locs.select("loc", "w", *AXES), "locations")
        total = locs.count()
        # On the sphere about pi * 4^level cells are in use at a level.
        self.base = max(0, math.ceil(math.log(max(total / leaf / math.pi, 1.0), 4)))
        box = [f(v).alias(f"{p}{v}") for v in AXES for f, p in ((F.min, "lo_"), (F.max, "hi_"))]
        self._cells: dict[int, DataFrame] = {}
        leaf_tables = []
        rest, level = locs, self.base
        while True:
            placed = rest.select("loc", "w", *AXES, *_cells_at(level))
            cells = materialise(
                placed.groupBy(*CELL)
                .agg(F.count(F.lit(1)).alias("n_locs"), F.sum("w").alias("w"), *box)
                .withColumn("is_leaf", (F.col("n_locs") <= leaf) | F.lit(level >= MAX_LEVEL)),
                "cells",
            )
            self._cells[level] = cells
            crowded = cells.filter(~F.col("is_leaf"))
            leaf_tables.append(
                placed.join(cells.filter("is_leaf").select(*CELL), CELL, "left_semi").withColumn("level", F.lit(level))
            )
            if crowded.isEmpty():
                break
            rest = materialise(placed.join(crowded.select(*CELL), CELL, "left_semi").select("loc", "w", *AXES), "crowded")
            level += 1
        self.depth = level
        up = self._cells[self.base]
        for lower in range(self.base - 1, -1, -1):
            merge = [f(f"{p}{v}").alias(f"{p}{v}") for v in AXES for f, p in ((F.min, "lo_"), (F.max, "hi_"))]
            up = materialise(
                up.select(*[_parent(c) for c in CELL], "n_locs", "w", *[f"{p}{v}" for v in AXES for p in ("lo_", "hi_")])
                .groupBy(*CELL)
                .agg(F.sum("n_locs").alias("n_locs"), F.sum("w").alias("w"), *merge)
                .withColumn("is_leaf", F.lit(False)),
                "cells",
            )
            self._cells[lower] = up
        leaf_of = ["level", *CELL]
        leaves = materialise(reduce(lambda a, b: a.unionByName(b), leaf_tables), "leaves")
        boxes = leaves.groupBy(*leaf_of).agg(
            F.min("loc").alias("q"), *[f(v).alias(f"q{p}{v}") for v in AXES for f, p in ((F.min, "lo_"), (F.max, "hi_"))]
        )
        self.boxes = materialise(boxes, "boxes")
        self.leaves = leaves

    def at(self, level: int) -> DataFrame:
        return self._cells[level]

    def queries(self) -> DataFrame:
        """One query per leaf: its name ``q`` (its smallest location) and its box."""
        return self.boxes.drop("level", *CELL)

    def members(self) -> DataFrame:
        """(q, loc, px, py, pz): the locations of every query."""
        named = self.leaves.join(self.boxes.select("q", "level", *CELL), ["level", *CELL])
        return named.select("q", "loc", *[F.col(v).alias(f"p{v}") for v in AXES])


def _box_distances(lo: str, hi: str, other_lo: str, other_hi: str) -> dict[str, Column]:
    """Squared smallest and largest distance between a spot of one box and a spot of another."""
    add = lambda parts: reduce(lambda a, b: a + b, parts)
    near = [
        F.greatest(F.col(f"{other_lo}{v}") - F.col(f"{hi}{v}"), F.col(f"{lo}{v}") - F.col(f"{other_hi}{v}"), F.lit(0.0))
        for v in AXES
    ]
    far = [
        F.greatest(F.col(f"{other_hi}{v}") - F.col(f"{lo}{v}"), F.col(f"{hi}{v}") - F.col(f"{other_lo}{v}")) for v in AXES
    ]
    return {"near": add([g * g for g in near]), "far": add([r * r for r in far])}


def slack(limit):
    """What rounding may add to a squared chord of about ``limit`` (a number or a column).

    Coordinates lie on the unit sphere, so their rounding moves a chord by some
    1e-15 and its square by as much times the chord.
    """
    root = F.sqrt(limit) if isinstance(limit, Column) else limit**0.5
    return limit * 1e-9 + root * 8e-15 + 1e-29


QUERY_BOX = [f"q{p}{v}" for v in AXES for p in ("lo_", "hi_")]


def _walk_down(tree: CellTree, keep, settle=None) -> tuple[DataFrame, list[DataFrame]]:
    """Walk the leaves of the tree, as queries, down the tree itself.

    The frontier holds (query leaf, cell) rows with the smallest and largest
    distance between their boxes; it has a few rows per leaf, not per point.
    ``keep(frontier)`` drops rows that cannot matter for any point of the query,
    ``settle(frontier)`` may take rows out as final and returns (final, rest).
    Returns the (query leaf, leaf) rows that remain, and the final rows.
    """
    finals, leaf_rows = [], []
    eight = _grid(0, 1)
    # At level 0 a coordinate of exactly 1 falls into cell 1, all others into cell 0.
    starts = tree.queries().withColumn("_o", F.explode(eight))
    frontier = starts.withColumns({c: F.col(f"_o.{o}").cast("bigint") for c, o in zip(CELL, "ijk")}).drop("_o")
    for level in range(tree.depth + 1):
        hit = frontier.join(tree.at(level), CELL).withColumns(_box_distances("qlo_", "qhi_", "lo_", "hi_"))
        kept = keep(hit)
        if settle is not None:
            final, kept = settle(kept)
            finals.append(final)
        kept = materialise(kept, "frontier")
        leaf_rows.append(kept.filter("is_leaf").withColumn("level", F.lit(level)))
        if level == tree.depth:
            break
        inner = kept.filter(~F.col("is_leaf")).select("q", *QUERY_BOX, *CELL)
        frontier = (
            inner.withColumn("_o", F.explode(eight))
            .withColumns({c: F.col(c) * 2 + F.col(f"_o.{o}") for c, o in zip(CELL, "ijk")})
            .drop("_o")
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), leaf_rows), finals


def _point_pairs(tree: CellTree, rows: DataFrame, limit: Column) -> DataFrame:
    """(loc, other, w, square) for points of the query leaves and points of the leaves they still hold.

    A point meets a leaf only if the leaf's box is within ``limit`` of the point itself.
    """
    gaps = [F.greatest(F.col(f"lo_{v}") - F.col(f"p{v}"), F.col(f"p{v}") - F.col(f"hi_{v}"), F.lit(0.0)) for v in AXES]
    gap = reduce(lambda a, b: a + b, [g * g for g in gaps])
    asked = tree.members().join(rows.withColumn("_limit", limit), "q").filter(gap <= F.col("_limit") + slack(F.col("_limit")))
    others = tree.leaves.select(F.col("loc").alias("other"), "w", "level", *CELL, *[F.col(v).alias(f"r{v}") for v in AXES])
    pairs = asked.select("loc", *[f"p{v}" for v in AXES], "level", *CELL).join(others, ["level", *CELL])
    return pairs.select("loc", "other", "w", _square("p", "r").alias("square"))


def neighbour_counts(locs: DataFrame, metres: float, leaf: int | None = None) -> DataFrame:
    """(loc, n_near): points within ``metres`` of each location, itself included.

    Cells that lie wholly inside the radius are added as one number, so a dense
    neighbourhood is counted without building its pairs.
    """
    tree = CellTree(locs.withColumn("w", F.col("n")), leaf or LEAF_LOCATIONS)
    limit = chord_of(metres) ** 2
    inside = F.col("far") <= limit - slack(limit)

    def settle(rows):
        return rows.filter(inside).select("q", F.col("w").alias("n")), rows.filter(~inside)

    rows, finals = _walk_down(tree, lambda hit: hit.filter(F.col("near") <= limit + slack(limit)), settle)
    pairs = _point_pairs(tree, rows, F.lit(limit)).filter(F.col("square") <= limit)
    whole = reduce(lambda a, b: a.unionByName(b), finals).groupBy("q").agg(F.sum("n").alias("n"))
    parts = pairs.select("loc", F.col("w").alias("n")).unionByName(tree.members().join(whole, "q").select("loc", "n"))
    return parts.groupBy("loc").agg(F.sum("n").alias("n_near"))


def nearest_neighbours(points: DataFrame, key: str, k: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The ``k`` nearest other points of every point: (key, rank, neighbour, metres). Exact; ties by key.

    Among points at one place only the ``k + 1`` smallest keys can be anyone's
    answer, so each location brings at most those. Locations, not points, are
    searched, a leaf of the cell tree at a time. A cell is kept for a leaf only
    while it can be nearer than the distance within which ``k + 1`` points are
    already known to lie.
    """
    from pyspark.sql import Window

    rows = points.select(F.col(key).alias("key"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))
    locs = materialise(locations(rows, "key"), "places")
    eligible = rank_at_most(rows, ["lon", "lat"], [F.col("key")], k + 1)
    answers = eligible.join(locs.select("lon", "lat", "loc"), ["lon", "lat"]).select("loc", F.col("key").alias("neighbour"))
    tree = CellTree(locs.withColumn("w", F.least("n", F.lit(k + 1).cast("bigint"))))

    def keep(hit):
        # Cells by their far side: the first cells that hold k + 1 points together bound the answer.
        by_far = Window.partitionBy("q").orderBy("far", *CELL).rowsBetween(Window.unboundedPreceding, 0)
        held = hit.withColumn("_held", F.sum("w").over(by_far))
        bound = F.min(F.when(F.col("_held") >= k + 1, F.col("far"))).over(Window.partitionBy("q"))
        held = held.withColumn("bound", F.coalesce(bound, F.lit(5.0))).drop("_held")  # squared chords end at 4
        return held.filter(F.col("near") <= F.col("bound") + slack(F.col("bound")))

    found, _ = _walk_down(tree, keep)
    pairs = _point_pairs(tree, found, F.col("bound")).select("loc", F.col("other"), "square")
    named = pairs.join(answers.withColumnRenamed("loc", "other"), "other")
    best = rank_at_most(named, ["loc"], [F.col("square"), F.col("neighbour")], k + 1).select("loc", "neighbour", "square")
    members = rows.join(locs.select("lon", "lat", "loc"), ["lon", "lat"]).select("key", "loc")
    mine = salted_join(members, best, ["loc"], salt_by=["key"]).filter(F.col("key") != F.col("neighbour"))
    ranked = rank_at_most(mine, ["key"], [F.col("square"), F.col("neighbour")], k)
    return ranked.select(F.col("key").alias(key), F.col("rn").alias("rank"), "neighbour", metres_of(F.col("square")).alias("metres"))


# A box is as long as at most this many cells of its level, so it touches one more along each axis.
BOX_FAN = 4
BOX_LEVELS = 14


def _box_level(length: Column) -> Column:
    """The finest level at which a side of ``length`` degrees touches few cells."""
    level = F.lit(0)
    for k in range(1, BOX_LEVELS):
        level = F.when(length <= F.lit(360.0 / BOX_FAN ** (k - 1)), k).otherwise(level)
    return level.cast("int")


def _box_cell(degrees: Column, level: Column) -> Column:
    """Number of the cell of a level, counted from 180 degrees west or 180 degrees south."""
    return F.floor((degrees + 180.0) / 360.0 * F.pow(F.lit(float(BOX_FAN)), level)).cast("bigint")


def points_in_boxes(
    points: DataFrame, boxes: DataFrame, lon: str, lat: str, west: str, south: str, east: str, north: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Pairs of a point and a box that holds it, edges included.

    A box runs east from ``west`` to ``east``; where ``west`` is greater it
    crosses the date line and is looked at as two. A box is laid on cells of two
    levels, one for its length along each axis, of which it touches at most
    ``BOX_FAN + 1`` an axis, so no box is copied more than (5 * 5) times a part,
    however large or thin. A point lies in one cell of each pair of levels that
    boxes use, and meets each box there once. Crowded cells are salted. The
    180th meridian is the same from both sides; boxes with a NULL edge or with
    ``south`` above ``north`` hold nothing.
    """
    edge = lambda a, b: F.struct(a.alias("w"), b.alias("e"))
    left, right, line = F.lit(-180.0), F.lit(180.0), F.col(east) >= 180.0
    w, e = F.col(west).cast("double"), F.col(east).cast("double")
    # Points lie in [-180, 180): what ends at 180 also holds the points at -180.
    parts = (
        F.when(w > e, F.array(edge(w, right), edge(left, e)))
        .when(line & (w > left), F.array(edge(w, e), edge(left, left)))
        .otherwise(F.array(edge(w, e)))
    )
    good = boxes.filter(F.col(south) <= F.col(north)).filter(w.isNotNull() & e.isNotNull())
    laid = good.withColumn("_part", F.explode(parts))
    laid = laid.withColumns(
        {"_lx": _box_level(F.col("_part.e") - F.col("_part.w")), "_ly": _box_level(F.col(north) - F.col(south))}
    )
    cells = lambda a, b, level: F.sequence(_box_cell(a, level), _box_cell(b, level))
    laid = laid.withColumn("_x", F.explode(cells(F.col("_part.w"), F.col("_part.e"), F.col("_lx"))))
    laid = laid.withColumn("_y", F.explode(cells(F.col(south), F.col(north), F.col("_ly"))))
    laid = materialise(laid, "boxes")
    used = laid.select("_lx", "_ly").distinct().collect()  # at most BOX_LEVELS squared
    levels = F.array(*[F.struct(F.lit(r["_lx"]).alias("_lx"), F.lit(r["_ly"]).alias("_ly")) for r in sorted(used)])
    if not used:
        return points.sparkSession.createDataFrame([], StructType([*points.schema.fields, *boxes.schema.fields]))
    at = F.when(F.col(lon) >= 180.0, F.col(lon) - 360.0).otherwise(F.col(lon))
    chain = points.withColumn("_at", at).withColumn("_l", F.explode(levels)).select("*", "_l.*").drop("_l")
    chain = chain.withColumns({"_x": _box_cell(F.col("_at"), F.col("_lx")), "_y": _box_cell(F.col(lat), F.col("_ly"))})
    met = salted_join(chain, laid, ["_lx", "_ly", "_x", "_y"], max_rows=max_rows)
    inside = F.col("_at").between(F.col("_part.w"), F.col("_part.e")) & F.col(lat).between(F.col(south), F.col(north))
    return met.filter(inside).drop("_lx", "_ly", "_x", "_y", "_at", "_part")
