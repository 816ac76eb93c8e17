"""Cells on a space-filling curve over the sphere, as 64-bit ids.

The sphere is projected on the six faces of a cube, a face is cut into four
again and again, and cells are numbered along a Hilbert curve: three bits of
face, two bits a level, a one, zeros. An id of any level is a whole number, ids
inside a cell are a range around its id, and near places have near ids, so one
sort key clusters a table by place and a cell is a range scan.

The numbering is the public S2 one; ids above 2^63 come out negative, as they do
in any signed 64-bit column.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVEL = 30
# The order of the four parts (2 * i + j) along the curve in each of its four
# orientations, and how a part's own orientation differs from its parent's.
PARTS = ((0, 1, 3, 2), (0, 2, 3, 1), (3, 2, 0, 1), (3, 1, 0, 2))
TURNS = (1, 0, 0, 3)
# Levels one look-up goes down.
STEP = 4


def _lookup() -> list[int]:
    """By orientation, i and j (STEP bits each): the places along the curve, then the orientation there."""
    out = []
    for key in range(4 << 2 * STEP):
        turn, i, j, place = key >> 2 * STEP, key >> STEP & (1 << STEP) - 1, key & (1 << STEP) - 1, 0
        for bit in reversed(range(STEP)):
            part = PARTS[turn].index((i >> bit & 1) * 2 + (j >> bit & 1))
            place, turn = place * 4 + part, turn ^ TURNS[part]
        out.append(place * 4 + turn)
    return out


def face_point(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Face of the cube (0 to 5) and coordinates on it from 0 to 1."""
    lon, lat = F.radians(lon), F.radians(lat)
    x, y, z = F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)
    far = F.greatest(F.abs(x), F.abs(y), F.abs(z))
    axis = F.when(F.abs(x) == far, F.when(x < 0, 3).otherwise(0))
    axis = axis.when(F.abs(y) == far, F.when(y < 0, 4).otherwise(1)).otherwise(F.when(z < 0, 5).otherwise(2))
    pick = lambda *by_face: F.element_at(F.array(*by_face), axis + 1)
    # Which coordinate lies along each side of the six faces.
    main = pick(x, y, z, x, y, z)
    u = pick(y, -x, -x, z, z, -y) / main
    v = pick(z, z, -y, y, -x, -x) / main
    # Cells of a level are made nearly equal in area.
    even = lambda c: F.when(c >= 0, 0.5 * F.sqrt(1 + 3 * c)).otherwise(1 - 0.5 * F.sqrt(1 - 3 * c))
    return axis, even(u), even(v)


def cell_id(lon: Column, lat: Column, level: int = MAX_LEVEL) -> Column:
    """Id of the cell of ``level`` that holds a place; NULL where a coordinate is."""
    if not 0 <= level <= MAX_LEVEL:
        raise ValueError("level must be from 0 to 30")
    face, s, t = face_point(lon, lat)
    size = 1 << MAX_LEVEL
    whole = lambda c: F.greatest(F.least(F.floor(c * size), F.lit(size - 1)), F.lit(0)).cast("bigint")
    table = F.array(*[F.lit(v) for v in _lookup()])
    bits = lambda c, k: F.call_function("shiftright", c, k).bitwiseAND(F.lit((1 << STEP) - 1).cast("bigint"))

    # 30 levels in 8 look-ups: the first has two levels of zeros on top, which turn the curve and turn it back.
    def step(state: Column, k: Column) -> Column:
        key = state["turn"] * (1 << 2 * STEP) + bits(state["i"], k) * (1 << STEP) + bits(state["j"], k)
        found = F.element_at(table, (key + 1).cast("int"))
        return F.struct(
            F.call_function("shiftleft", state["place"], F.lit(2 * STEP)).bitwiseOR(F.call_function("shiftright", found, F.lit(2))).cast("bigint").alias("place"),
            found.bitwiseAND(F.lit(3)).cast("bigint").alias("turn"),
            state["i"].alias("i"),
            state["j"].alias("j"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("place"),
        face.bitwiseAND(F.lit(1)).cast("bigint").alias("turn"),
        whole(s).alias("i"),
        whole(t).alias("j"),
    )
    steps = F.array(*[F.lit(k) for k in range(28, -1, -STEP)])
    place = F.aggregate(steps, start, step)["place"]
    leaf = F.call_function("shiftleft", face.cast("bigint"), F.lit(61)).bitwiseOR(
        F.call_function("shiftleft", place, F.lit(1)).bitwiseOR(F.lit(1).cast("bigint"))
    )
    known = lon.isNotNull() & lat.isNotNull()
    return F.when(known, parent(leaf, level))


def _last(level: int) -> int:
    return 1 << 2 * (MAX_LEVEL - level)


def parent(cell: Column, level: int) -> Column:
    """The cell of a coarser ``level`` around a cell."""
    last = _last(level)
    return cell.bitwiseAND(F.lit(-last).cast("bigint")).bitwiseOR(F.lit(last).cast("bigint"))


def level_of(cell: Column) -> Column:
    """Level of a cell id."""
    zeros = F.length(F.regexp_extract(F.bin(cell), "0*$", 0))
    return (F.lit(MAX_LEVEL) - F.floor(zeros / 2)).cast("int")


def inside(cell: Column, parent_id: int, level: int) -> Column:
    """Whether a leaf cell lies in a cell: a range of ids, which a scan can push down."""
    reach = _last(level) - 1
    return cell.between(F.lit(parent_id - reach).cast("bigint"), F.lit(parent_id + reach).cast("bigint"))


def cluster_by_cell(df: DataFrame, lon: str, lat: str, path: str, name: str = "cell", files: int | None = None) -> None:
    """Write a table in the order of the curve: each file holds a stretch of it, so a range of cells is in few files."""
    placed = df.withColumn(name, cell_id(F.col(lon), F.col(lat)))
    ranged = placed.repartitionByRange(files, name) if files else placed.repartitionByRange(name)
    ranged.sortWithinPartitions(name).write.parquet(path)
