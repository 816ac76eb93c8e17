"""Proximity, neighbour, cluster and grid queries over points."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.cells import cell_id, parent
from tidewater.operators.clusters import density_cluster
from tidewater.operators.farthest import farthest_pairs
from tidewater.operators.spatial import (
    extent_centroid,
    geohash,
    locations,
    nearest_neighbours,
    points_in_boxes,
    proximity_join,
    snap,
)
from tidewater.plans.registry import query
from tidewater.session import table

SCALE = 100.0

POINTS_SQL = f"(SELECT vec_id, label, embedding[1]::DOUBLE * {SCALE} AS lon, embedding[2]::DOUBLE * {SCALE} AS lat FROM embeddings)"
METRES_SQL = (
    "2 * 6371010.0 * asin(least(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * "
    "cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)), 1.0))"
)


def points(spark, sf_dir):
    """The first two vector entries, scaled, as longitude and latitude."""
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        (e[0].cast("double") * SCALE).alias("lon"),
        (e[1].cast("double") * SCALE).alias("lat"),
    )


RADIUS = 150_000.0


@query(
    "proximity_join",
    f"""
    SELECT a.loc AS left_loc, b.loc AS right_loc, a.n AS left_n, b.n AS right_n, round({METRES_SQL}, 2) AS metres
    FROM (SELECT lon, lat, min(vec_id) AS loc, count(*) AS n FROM {POINTS_SQL} WHERE label < 5 GROUP BY lon, lat) a
    JOIN (SELECT lon, lat, min(vec_id) AS loc, count(*) AS n FROM {POINTS_SQL} WHERE label >= 5 GROUP BY lon, lat) b
    ON {METRES_SQL} <= {RADIUS}
    """,
)
def proximity_join_query(spark, sf_dir):
    """Places of the lower labels with the places of the higher labels within 150 km."""
    all_points = points(spark, sf_dir)
    low, high = all_points.filter("label < 5"), all_points.filter("label >= 5")
    pairs = proximity_join(locations(low, "vec_id"), locations(high, "vec_id"), RADIUS)
    return pairs.withColumn("metres", F.round("metres", 2))


@query(
    "nearest_neighbours",
    f"""
    SELECT a.vec_id, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {METRES_SQL}, b.vec_id) AS INTEGER) AS rank,
           b.vec_id AS neighbour, round({METRES_SQL}, 3) AS metres
    FROM {POINTS_SQL} a JOIN {POINTS_SQL} b ON a.vec_id <> b.vec_id
    QUALIFY rank <= 3
    """,
)
def nearest_neighbours_query(spark, sf_dir):
    """The three nearest other points of every point."""
    return nearest_neighbours(points(spark, sf_dir), "vec_id", 3).withColumn("metres", F.round("metres", 3))


# Points spread over the whole globe, and boxes of half a degree to fifty around some of them.
_GLOBE = """
    WITH g AS (SELECT vec_id, label, x - 360.0 * floor((x + 180.0) / 360.0) AS lon, greatest(least(y, 90.0), -90.0) AS lat
               FROM (SELECT vec_id, label, embedding[1]::DOUBLE * 1500.0 AS x, embedding[2]::DOUBLE * 250.0 AS y FROM embeddings)),
         b AS (SELECT vec_id AS box_id, w - 360.0 * floor((w + 180.0) / 360.0) AS west, lat - size / 4.0 AS south,
                      e - 360.0 * floor((e + 180.0) / 360.0) AS east, lat + size / 8.0 AS north
               FROM (SELECT *, lon - size AS w, lon + size AS e FROM (SELECT *, (label + 1.0) * (label + 1.0) / 4.0 AS size FROM g WHERE vec_id % 10 = 0)))
"""


def _globe(spark, sf_dir):
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        _wrapped(e[0].cast("double") * 1500.0).alias("lon"),
        F.greatest(F.least(e[1].cast("double") * 250.0, F.lit(90.0)), F.lit(-90.0)).alias("lat"),
    )


def _wrapped(x):
    return x - 360.0 * F.floor((x + 180.0) / 360.0)


@query(
    "points_in_boxes",
    _GLOBE
    + """
    SELECT box_id, vec_id FROM b, g WHERE lat BETWEEN south AND north
      AND CASE WHEN west <= east THEN lon BETWEEN west AND east ELSE lon >= west OR lon <= east END
    """,
)
def points_in_boxes_query(spark, sf_dir):
    """All points in longitude and latitude boxes, some of which cross the date line."""
    globe = _globe(spark, sf_dir)
    size = (F.col("label") + 1.0) * (F.col("label") + 1.0) / 4.0
    boxes = globe.filter("vec_id % 10 = 0").select(
        F.col("vec_id").alias("box_id"),
        _wrapped(F.col("lon") - size).alias("west"),
        (F.col("lat") - size / 4.0).alias("south"),
        _wrapped(F.col("lon") + size).alias("east"),
        (F.col("lat") + size / 8.0).alias("north"),
    )
    found = points_in_boxes(globe.select("vec_id", "lon", "lat"), boxes, "lon", "lat", "west", "south", "east", "north")
    return found.select("box_id", "vec_id")


@query(
    "farthest_pairs",
    f"""
    SELECT a.label AS a, b.label AS b, round(max({METRES_SQL}), 2) AS metres
    FROM {POINTS_SQL} a JOIN {POINTS_SQL} b ON a.label <= b.label GROUP BY a.label, b.label
    """,
)
def farthest_pairs_query(spark, sf_dir):
    """The largest distance between points of each two labels."""
    all_points = points(spark, sf_dir)
    labels = all_points.select("label").distinct()
    last = labels.agg(F.max("label").alias("last"))
    upto = labels.select(F.col("label").alias("a"), F.explode(F.sequence("label", F.lit(last.first()["last"]))).alias("b"))
    found = farthest_pairs(all_points, upto, "vec_id", "label")
    return found.select("a", "b", F.round("metres", 2).alias("metres"))


@query(
    "cell_rollup",
    _GLOBE.replace("WITH", "WITH RECURSIVE", 1)
    + """, p AS (SELECT vec_id, label, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM g),
    f AS (SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN CASE WHEN x < 0 THEN 3 ELSE 0 END
                         WHEN abs(y) >= abs(z) THEN CASE WHEN y < 0 THEN 4 ELSE 1 END ELSE CASE WHEN z < 0 THEN 5 ELSE 2 END END AS face FROM p),
    uv AS (SELECT vec_id, label, face, [y / x, -x / y, -x / z, z / x, z / y, -y / z][face + 1] AS u, [z / x, z / y, -y / z, y / x, -x / y, -x / z][face + 1] AS v FROM f),
    st AS (SELECT *, CASE WHEN u >= 0 THEN 0.5 * sqrt(1 + 3 * u) ELSE 1 - 0.5 * sqrt(1 - 3 * u) END AS s, CASE WHEN v >= 0 THEN 0.5 * sqrt(1 + 3 * v) ELSE 1 - 0.5 * sqrt(1 - 3 * v) END AS t FROM uv),
    h AS (SELECT vec_id, label, face, CAST(least(floor(s * 1073741824.0), 1073741823) AS BIGINT) AS i, CAST(least(floor(t * 1073741824.0), 1073741823) AS BIGINT) AS j,
                 0 AS level, face & 1 AS turn, 0::HUGEINT AS place FROM st
          UNION ALL
          SELECT vec_id, label, face, i, j, level + 1, xor(turn, [1, 0, 0, 3][q + 1]), place * 4 + q
          FROM (SELECT *, [[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]][turn + 1][((i >> (29 - level)) & 1) * 2 + ((j >> (29 - level)) & 1) + 1] AS q FROM h WHERE level < 9)),
    c AS (SELECT level, label, face * 2305843009213693952::HUGEINT + place * (1::HUGEINT << (61 - 2 * level)) + (1::HUGEINT << (60 - 2 * level)) AS c FROM h WHERE level IN (2, 5, 9))
    SELECT level, CAST(CASE WHEN c >= 9223372036854775808::HUGEINT THEN c - 18446744073709551616::HUGEINT ELSE c END AS BIGINT) AS cell, count(*) AS n, CAST(sum(label) AS BIGINT) AS sum_label
    FROM c GROUP BY ALL
    """,
)
def cell_rollup(spark, sf_dir):
    """Points counted in the cells of three levels; each level is the parents' ids of the finest one."""
    finest = _globe(spark, sf_dir).groupBy(cell_id(F.col("lon"), F.col("lat"), 9).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("sum_label")
    )
    levels = F.array(*[F.struct(F.lit(k).alias("level"), parent(F.col("cell"), k).alias("cell")) for k in (2, 5, 9)])
    at = finest.select(F.explode(levels).alias("at"), "n", "sum_label").select("at.*", "n", "sum_label")
    return at.groupBy("level", "cell").agg(F.sum("n").alias("n"), F.sum("sum_label").alias("sum_label"))


@query(
    "extent_centroid",
    f"""
    SELECT label, min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat, count(*) AS n,
           round(degrees(atan2(sum(y), sum(x))), 6) AS centroid_lon, round(degrees(atan2(sum(z), sqrt(sum(x) * sum(x) + sum(y) * sum(y)))), 6) AS centroid_lat
    FROM (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM {POINTS_SQL})
    GROUP BY label
    """,
)
def extent_centroid_query(spark, sf_dir):
    out = extent_centroid(points(spark, sf_dir), ["label"])
    return out.withColumns({c: F.round(c, 6) for c in ("centroid_lon", "centroid_lat")})


def _geohash_sql(length: int) -> str:
    bits = 5 * length
    nx, ny = (bits + 1) // 2, bits // 2
    x = f"CAST(floor((lon + 180.0) / 360.0 * {1 << nx}) AS BIGINT)"
    y = f"CAST(floor((lat + 90.0) / 180.0 * {1 << ny}) AS BIGINT)"
    letters = []
    for start in range(0, bits, 5):
        terms = []
        for j in range(5):
            i = start + j
            source, shift = (x, nx - 1 - i // 2) if i % 2 == 0 else (y, ny - 1 - i // 2)
            terms.append(f"(({source} >> {shift}) & 1) * {16 >> j}")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({' + '.join(terms)} + 1 AS BIGINT), 1)")
    return " || ".join(letters)


STEPS = [40.0, 10.0, 2.5]


@query(
    "grid_rollup",
    " UNION ALL ".join(
        f"SELECT 'grid {s}' AS level, CAST(floor(lon / {s}) AS BIGINT) || ':' || CAST(floor(lat / {s}) AS BIGINT) AS cell, "
        f"count(*) AS n, CAST(sum(label) AS BIGINT) AS sum_label FROM {POINTS_SQL} GROUP BY ALL"
        for s in STEPS
    )
    + f" UNION ALL SELECT 'geohash 4', {_geohash_sql(4)} AS cell, count(*), CAST(sum(label) AS BIGINT) FROM {POINTS_SQL} GROUP BY cell",
)
def grid_rollup(spark, sf_dir):
    """Counts per grid cell at three levels, and per geohash, in one pass.

    Each point is listed under its cell of every level; the counts combine
    before the shuffle.
    """
    lon, lat = F.col("lon"), F.col("lat")
    cells = [
        F.struct(
            F.lit(f"grid {s}").alias("level"),
            F.concat_ws(":", snap(lon, s).cast("string"), snap(lat, s).cast("string")).alias("cell"),
        )
        for s in STEPS
    ] + [F.struct(F.lit("geohash 4").alias("level"), geohash(lon, lat, 4).alias("cell"))]
    listed = points(spark, sf_dir).select("label", F.inline(F.array(*cells)))
    return listed.groupBy("level", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("sum_label"))


EPS, MIN_POINTS = 200_000.0, 5


@query(
    "density_cluster",
    f"""
    WITH RECURSIVE p AS {POINTS_SQL},
    near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON {METRES_SQL} <= {EPS}),
    core AS (SELECT a FROM near GROUP BY a HAVING count(*) >= {MIN_POINTS}),
    linked AS (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    reach(a, r) AS (SELECT a, a FROM core UNION SELECT linked.b, reach.r FROM reach JOIN linked ON linked.a = reach.a),
    grp AS (SELECT a, min(r) AS cluster FROM reach GROUP BY a)
    SELECT p.vec_id, min(grp.cluster) AS cluster, p.vec_id IN (SELECT a FROM core) AS is_core
    FROM p LEFT JOIN near ON near.a = p.vec_id AND (NOT p.vec_id IN (SELECT a FROM core) OR near.b = p.vec_id)
    LEFT JOIN grp ON grp.a = near.b GROUP BY p.vec_id
    """,
)
def density_cluster_query(spark, sf_dir):
    """Clusters of points that have at least five points, themselves included, within 200 km."""
    return density_cluster(points(spark, sf_dir), "vec_id", EPS, MIN_POINTS)
