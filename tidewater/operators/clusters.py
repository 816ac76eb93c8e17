"""Connected components and density clusters."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.skew import MAX_GROUP_ROWS, salted_join
from tidewater.operators.spatial import (
    AXES,
    CELL,
    MAX_LEVEL,
    slack,
    _cell,
    _spread,
    _square,
    chord_of,
    locations,
    touching_cells,
)
from tidewater.session import materialise

MAX_ROUNDS = 200


def _are_stars(edges: DataFrame) -> bool:
    """Every node has at most one outgoing edge, and no target has one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    degrees = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return degrees.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each node's connected component.

    ``nodes`` has the column id, ``edges`` u and v. Alternates the large-star
    and small-star steps (Kiveris et al., "Connected Components in MapReduce and
    Beyond"): every node points its larger neighbours at the smallest one known,
    which ends in stars after a logarithmic number of rounds even for long
    chains. Each round is written out, so lineage stays short.
    """
    current = materialise(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    for _ in range(MAX_ROUNDS):
        if _are_stars(current):
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = materialise(large, "large-star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u")
            .filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = materialise(small, "small-star")
    else:
        raise RuntimeError("components did not settle")
    stars = current.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
    return nodes.join(stars, "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def _box_gap(a: str, b: str) -> Column:
    gaps = [
        F.greatest(F.col(f"{a}lo_{v}") - F.col(f"{b}hi_{v}"), F.col(f"{b}lo_{v}") - F.col(f"{a}hi_{v}"), F.lit(0.0))
        for v in AXES
    ]
    return reduce(lambda s, t: s + t, [g * g for g in gaps])


def _linked_groups(members: DataFrame, pairs: DataFrame, size: float, limit: float) -> DataFrame:
    """Pairs (a, b) of groups that hold two locations, one of each, within reach of one another.

    ``members`` has node and x, y, z. Never pairs the locations of two groups:
    both are halved into sub-cells round by round, and a pair of sub-cells is
    dropped when their boxes are too far apart, settles its groups as soon as
    the sub-cells' representatives are near enough, and is halved again
    otherwise.
    """
    names = [f"s{c}" for c in CELL]
    described = [f"{p}{v}" for v in AXES for p in ("lo_", "hi_", "rep_")]

    def parts(rows: DataFrame, level: int) -> DataFrame:
        width = size / 2**level
        slots = [F.floor(F.col(v) / F.lit(width)).cast("bigint").alias(n) for v, n in zip(AXES, names)]
        rep = F.min(F.struct(*AXES)).alias("rep")
        box = [f(v).alias(f"{p}{v}") for v in AXES for f, p in ((F.min, "lo_"), (F.max, "hi_"))]
        grouped = rows.select("node", *AXES, *slots).groupBy("node", *names).agg(rep, *box)
        return grouped.select("node", *names, *box_names, *[F.col(f"rep.{v}").alias(f"rep_{v}") for v in AXES])

    box_names = [f"{p}{v}" for v in AXES for p in ("lo_", "hi_")]

    def side(rows: DataFrame, p: str) -> DataFrame:
        return rows.select(F.col("node").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in (*names, *described)])

    def judged(rows: DataFrame) -> DataFrame:
        close = _box_gap("a_", "b_") <= limit + slack(limit)
        reps = reduce(
            lambda s, t: s + t,
            [(F.col(f"a_rep_{v}") - F.col(f"b_rep_{v}")) * (F.col(f"a_rep_{v}") - F.col(f"b_rep_{v}")) for v in AXES],
        )
        return rows.filter(close).select(
            "a", "b", *[f"{p}_{n}" for p in "ab" for n in names], (reps <= limit).alias("linked")
        )

    whole = parts(members, 0)
    open_pairs = pairs.join(side(whole, "a"), "a").join(side(whole, "b"), "b")
    linked = []
    for level in range(1, MAX_LEVEL):
        found = materialise(judged(open_pairs), "judged")
        done = found.filter("linked").select("a", "b").distinct()
        linked.append(done)
        rest = materialise(found.filter("NOT linked").drop("linked").join(done, ["a", "b"], "left_anti"), "undecided")
        if rest.isEmpty():
            break
        busy = rest.select(F.col("a").alias("node")).unionByName(rest.select(F.col("b").alias("node"))).distinct()
        finer = materialise(parts(members.join(busy, "node", "left_semi"), level), "parts")

        def children(p: str) -> DataFrame:
            up = [F.shiftright(F.col(f"{p}_{n}"), 1).alias(f"_{p}_{n}") for n in names]
            return side(finer, p).select("*", *up)

        def descend(rows: DataFrame, p: str) -> DataFrame:
            old = rows.withColumnsRenamed({f"{p}_{n}": f"_{p}_{n}" for n in names})
            on = [p, *[f"_{p}_{n}" for n in names]]
            return old.join(children(p), on).drop(*on[1:])

        open_pairs = descend(descend(rest, "a"), "b")
    else:
        raise RuntimeError("groups of locations did not settle")
    return reduce(lambda x, y: x.unionByName(y), linked).distinct()


def density_cluster(
    points: DataFrame,
    key: str,
    metres: float,
    min_points: int,
    lon: str = "lon",
    lat: str = "lat",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """DBSCAN on the sphere: (key, cluster, is_core); cluster is NULL for noise.

    A cluster is named by its smallest core key. A border point within reach of
    several clusters goes to the smallest name.

    Cells are so small that all points of a cell are within reach of each other.
    A cell with ``min_points`` points is therefore all core, and counts as one
    node; only the few points of thin cells are compared with their
    surroundings, so the number of pairs grows with the points and not with
    their square, however dense a place gets.
    """
    rows = points.select(F.col(key).alias("key"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))
    reach = chord_of(metres)
    limit = reach * reach
    size = reach / math.sqrt(3) * (1 - 1e-9)
    places = materialise(locations(rows, "key").select("lon", "lat", "loc", "n", *AXES, *_cell(size)), "places")

    cells = materialise(places.groupBy(*CELL).agg(F.sum("n").alias("cell_n")), "cells")
    dense = cells.filter(F.col("cell_n") >= min_points).select(*CELL)
    in_dense = places.join(dense, CELL, "left_semi")
    in_thin = places.join(dense, CELL, "left_anti")

    # Points of thin cells (fewer than min_points a cell) against all points around them.
    asking = in_thin.select(
        F.col("loc").alias("q"), *[F.col(v).alias(f"q{v}") for v in AXES], *[F.col(c).alias(f"a{c}") for c in CELL]
    )
    probes = asking.join(touching_cells(in_thin, cells, 2), [f"a{c}" for c in CELL]).withColumnsRenamed(
        {f"a{c}": f"q{c}" for c in CELL}
    )
    around = salted_join(
        places.select("loc", "n", *[F.col(v).alias(f"p{v}") for v in AXES], *CELL), probes, CELL, salt_by=["loc"], max_rows=max_rows
    )
    near = materialise(
        around.filter(_square("q", "p") <= F.lit(limit)).select("q", *[f"q{c}" for c in CELL], "loc", "n", *CELL), "near"
    )
    thin_core = (
        near.groupBy("q").agg(F.sum("n").alias("n_near")).filter(F.col("n_near") >= min_points).select(F.col("q").alias("loc"))
    )
    core = materialise(
        in_dense.select("loc", *AXES, *CELL).unionByName(in_thin.join(thin_core, "loc", "left_semi").select("loc", *AXES, *CELL)),
        "core",
    )
    # A node per cell that holds core points, named by the smallest of them.
    nodes = materialise(core.groupBy(*CELL).agg(F.min("loc").alias("node")), "nodes")
    core_near = near.join(nodes, CELL).join(core.select("loc"), "loc", "left_semi")
    thin_nodes = nodes.select(F.col("node").alias("q_node"), *[F.col(c).alias(f"q{c}") for c in CELL])
    thin_edges = (
        core_near.join(core.select(F.col("loc").alias("q")), "q", "left_semi")
        .join(thin_nodes, [f"q{c}" for c in CELL])
        .select(F.col("q_node").alias("u"), F.col("node").alias("v"))
        .distinct()
    )
    dense_nodes = nodes.join(dense, CELL, "left_semi")
    touching = (
        _spread(dense_nodes.select(F.col("node").alias("a"), *CELL), 2)
        .join(dense_nodes.select(F.col("node").alias("b"), *CELL), CELL)
        .filter(F.col("a") < F.col("b"))
        .select("a", "b")
    )
    members = in_dense.join(dense_nodes, CELL).select("node", *AXES)
    dense_edges = _linked_groups(members, touching, size, limit).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(nodes.select(F.col("node").alias("id")), thin_edges.unionByName(dense_edges))
    cell_roots = materialise(nodes.join(roots, F.col("node") == F.col("id")).select(*CELL, "root"), "roots")

    of_core = core.join(cell_roots, CELL).select("loc", F.col("root").alias("cluster"), F.lit(True).alias("is_core"))
    border = (
        core_near.join(core.select(F.col("loc").alias("q")), "q", "left_anti")
        .join(cell_roots, CELL)
        .groupBy(F.col("q").alias("loc"))
        .agg(F.min("root").alias("cluster"))
        .withColumn("is_core", F.lit(False))
    )
    named = places.select("lon", "lat", "loc").join(of_core.unionByName(border), "loc", "left").drop("loc")
    out = salted_join(rows, named, ["lon", "lat"], "left", salt_by=["key"], max_rows=max_rows)
    return out.select(F.col("key").alias(key), "cluster", F.coalesce("is_core", F.lit(False)).alias("is_core"))
