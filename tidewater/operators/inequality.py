"""Joins on two inequalities, counted without building a pair.

For ``left.x < right.x AND left.y > right.y`` and the like, every left row gets
the number of right rows that meet both conditions. A nested loop compares all
pairs; here each row is sent a few times:

1. rows are reduced to distinct (x, y), the right ones with how many there are;
2. x is cut into blocks of about ``block_rows`` by its percentiles. A value that
   is a cut has a block of its own, so a value that most rows share is never
   compared with itself;
3. pairs of different blocks: block numbers differ in one highest bit. At each
   bit, right rows on the matching side and left rows on the other meet in the
   group of the bits above it, and a running sum in the order of y counts what
   lies ahead (see ``skew.running``: no group has to fit in one task);
4. pairs of one block: a task holds the block, sorts it by x, and reads the
   counts off a tree of bit arrays over the ranks of y. A block of a single
   value is a running sum too, where equal values count.

x and y may be whole numbers, doubles, dates or times. NULL meets nothing; NaN is
above every number, as everywhere in Spark.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.frames import micros
from tidewater.operators.skew import MAX_GROUP_ROWS, running
from tidewater.session import materialise, ship

BLOCK_ROWS = 500_000
# Cuts are values the driver holds; more rows make larger blocks from then on.
MAX_BLOCKS = 1 << 14

_TRIPLE = "ox {x}, oy {y}, x bigint, y bigint, w bigint, block int"


def _plain(df: DataFrame, name: str) -> Column:
    """The column as bigint or double, in the same order."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return micros(F.col(name))
    if kind in ("float", "double"):
        return F.col(name).cast("double")
    if kind in ("byte", "short", "integer", "long"):
        return F.col(name).cast("bigint")
    raise TypeError(f"cannot order {name} of type {kind} in blocks; cast it to double or bigint")


def order_keys(values: np.ndarray, falling: bool) -> np.ndarray:
    """64-bit integers in the order of the values, NaN last; turned round where ``falling``."""
    if values.dtype.kind == "f":
        values = np.where(values == 0, 0.0, np.where(np.isnan(values), np.nan, values))
        bits = values.view(np.int64)
        values = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
    return ~values if falling else values


def weight_at_least(ranks: np.ndarray, weights: np.ndarray, first: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each question, the weight of the places from ``first`` on whose rank is ``least`` or more.

    ``ranks`` are 0 to n-1, each once. One bit array per bit of the ranks, from
    the highest: places are parted by the bit, and all questions follow theirs.
    """
    n = len(ranks)
    low, high = first.copy(), np.full(len(first), n)
    total = np.zeros(len(first), np.int64)
    for bit in range(n.bit_length() - 1, -1, -1):
        one = (ranks >> bit) & 1 == 1
        zeros = np.concatenate(([0], np.cumsum(~one)))
        above = np.concatenate(([0], np.cumsum(np.where(one, weights, 0))))
        follow = (least >> bit) & 1 == 1
        total += np.where(follow, 0, above[high] - above[low])
        low0, high0 = zeros[low], zeros[high]
        low = np.where(follow, zeros[-1] + low - low0, low0)
        high = np.where(follow, zeros[-1] + high - high0, high0)
        order = np.concatenate((np.flatnonzero(~one), np.flatnonzero(one)))
        ranks, weights = ranks[order], weights[order]
    upto = np.concatenate(([0], np.cumsum(weights)))
    return total + upto[high] - upto[low]


def _within_block(strict_x: bool, strict_y: bool):
    def count(rows: pa.Table) -> pa.Table:
        asks = rows.filter(pc.is_null(rows.column("w")))
        right = rows.filter(pc.is_valid(rows.column("w")))
        x, y, w = (right.column(c).to_numpy() for c in ("x", "y", "w"))
        by_x = np.argsort(x, kind="stable")
        x, y, w = x[by_x], y[by_x], w[by_x].astype(np.int64)
        by_y = np.argsort(y, kind="stable")
        ranks = np.empty(len(y), np.int64)
        ranks[by_y] = np.arange(len(y))
        side = lambda strict: "right" if strict else "left"
        first = np.searchsorted(x, asks.column("x").to_numpy(), side(strict_x))
        least = np.searchsorted(y[by_y], asks.column("y").to_numpy(), side(strict_y))
        n = weight_at_least(ranks, w, first, least)
        return pa.Table.from_arrays([asks.column("ox"), asks.column("oy"), pa.array(n, pa.int64())], names=["ox", "oy", "n"])

    return count


#: Whether the condition is strict, and whether the right value lies above (else below) the left one.
_CONDITIONS = {"<": (True, True), "<=": (False, True), ">": (True, False), ">=": (False, False)}


def count_matches(
    left: DataFrame, right: DataFrame, x: tuple[str, str, str], y: tuple[str, str, str], name: str = "n_matches",
    block_rows: int = BLOCK_ROWS, max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add to each left row how many right rows meet both conditions.

    A condition is (left column, ``<``, ``<=``, ``>`` or ``>=``, right column).
    """
    (lx, x_is, rx), (ly, y_is, ry) = x, y
    (strict_x, x_above), (strict_y, y_above) = _CONDITIONS[x_is], _CONDITIONS[y_is]
    ship(left.sparkSession)
    ask, held = "_ox", "_oy"
    asking = left.withColumns({ask: _plain(left, lx), held: _plain(left, ly)})
    places = lambda df, a, b: df.select(a.alias("ox"), b.alias("oy")).filter("ox IS NOT NULL AND oy IS NOT NULL")
    asks = places(asking, F.col(ask), F.col(held)).distinct().withColumn("w", F.lit(None).cast("bigint"))
    given = places(right, _plain(right, rx), _plain(right, ry)).groupBy("ox", "oy").agg(F.count(F.lit(1)).alias("w"))
    kinds = {c: asks.schema[c].dataType.simpleString() for c in ("ox", "oy")}
    if any(given.schema[c].dataType.simpleString() != kinds[c] for c in kinds):
        raise TypeError("the two sides of a condition must both be numbers of one kind or both be times")
    both = materialise(asks.unionByName(given), "places")

    blocks = min(MAX_BLOCKS, -(-both.count() // block_rows))
    share = [k / blocks for k in range(1, blocks)]
    cuts = both.agg(F.percentile_approx("ox", share, 10 * blocks)).first()[0] if share else []
    plain = np.float64 if kinds["ox"] == "double" else np.int64
    edges = np.unique(order_keys(np.array(cuts or [], plain), not x_above))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = order_keys(batch.column("ox").to_numpy(), not x_above)
            over = order_keys(batch.column("oy").to_numpy(), not y_above)
            block = np.searchsorted(edges, at, "left")
            is_cut = np.zeros(len(at), bool)
            inside = block < len(edges)
            is_cut[inside] = edges[block[inside]] == at[inside]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ox"), batch.column("oy"), pa.array(at), pa.array(over), batch.column("w"),
                 pa.array(2 * block + is_cut, pa.int32())],
                names=["ox", "oy", "x", "y", "w", "block"],
            )

    schema = _TRIPLE.format(x=kinds["ox"], y=kinds["oy"])
    placed = materialise(both.select("ox", "oy", "w").mapInArrow(place, schema), "placed")

    found = placed.filter("block % 2 = 0").groupBy("block").applyInArrow(
        _within_block(strict_x, strict_y), f"ox {kinds['ox']}, oy {kinds['oy']}, n bigint"
    )
    if len(edges):
        bit = lambda k: F.shiftright("block", k).bitwiseAND(F.lit(1))
        group = lambda k, node: F.struct(F.lit(k).alias("k"), node.alias("node"))
        high = F.when(F.col("w").isNull(), 0).otherwise(1)  # given rows lie on the high side of the ones that ask
        meets = [F.when(bit(k) == high, group(k, F.shiftright("block", k + 1))) for k in range((2 * len(edges)).bit_length())]
        if not strict_x:  # all of a block that is a single value
            meets.append(F.when(bit(0) == 1, group(-1, F.col("block"))))
        sent = placed.withColumn("l", F.explode(F.filter(F.array(*meets), lambda s: s.isNotNull())))
        sent = sent.select("l.k", "l.node", "y", "w", F.when(F.col("w").isNull(), F.col("block")).alias("block"))
        # Equal y: given rows come first where equality counts.
        side = F.when(F.col("w").isNull(), 0 if strict_y else 1).otherwise(1 if strict_y else 0)
        sent = sent.withColumn("side", side).groupBy("k", "node", "y", "side", "block").agg(F.sum("w").alias("w"))
        run = running(sent, ["k", "node"], [F.desc("y"), F.col("side")], {"n": ("sum", F.col("w"))}, max_rows)
        far = run.filter("block IS NOT NULL").groupBy("block", "y").agg(F.sum("n").alias("n"))
        asked = placed.filter("w IS NULL").select("ox", "oy", "y", "block")
        found = found.unionByName(asked.join(far, ["block", "y"]).select("ox", "oy", "n"))
    counted = found.groupBy(F.col("ox").alias(ask), F.col("oy").alias(held)).agg(F.sum("n").alias(name))
    joined = asking.join(counted, [ask, held], "left")
    return joined.select(*left.columns, F.coalesce(name, F.lit(0)).cast("bigint").alias(name))
