"""Aggregates over moving frames that cost the same for wide frames as for narrow ones.

Spark folds a sliding frame anew for every row. Here the smallest, the largest
and the number of distinct values over ``[at - width, at]`` come from running
values, which hold for hot groups too (see ``skew.running``):

* the axis is cut into blocks one frame wide, so a frame is the start of its own
  block and the end of the one before; both are running extremes of a block;
* a value is in the frame from its first place until ``width`` after its last
  one, gaps apart, so the number of distinct values is a running sum of values
  that come and go.

``at`` is a whole number: a row number, or the microseconds of a time
(``micros``). A frame of rows is one of row numbers. NULL places form a frame of
their own, as in any RANGE frame; NULL values are passed over.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.skew import MAX_GROUP_ROWS, null_safe_join, numbered, running, split_hot
from tidewater.session import materialise

# Frames of so few rows are left to Spark's own windows.
FEW_ROWS = 64


def micros(ts: Column) -> Column:
    """A date or time as microseconds of an even axis."""
    return F.unix_micros(ts.cast("timestamp"))


def previous(
    df: DataFrame, keys: Sequence[str], order: str, name: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add the value of ``order`` (unique in a group) in the row before, NULL in the first."""
    keys = list(keys)
    cold, hot, _ = split_hot(df, keys, max_rows)
    done = cold.withColumn(name, F.lag(order).over(Window.partitionBy(*keys).orderBy(order)))
    if hot is None:
        return done
    rows = materialise(numbered(hot, keys, [F.col(order)], "_rn", max_rows), "numbered")
    before = rows.select(*keys, (F.col("_rn") + 1).alias("_rn"), F.col(order).alias(name))
    return done.unionByName(null_safe_join(rows, before, [*keys, "_rn"], "left").select(*done.columns))


def sliding_extremes(
    df: DataFrame, keys: Sequence[str], at: str, width: int, value: Column, low: str, high: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """keys, ``at``, and the smallest and largest value in ``[at - width, at]``, for each distinct (group, at)."""
    keys, size = list(keys), F.lit(width + 1)
    points = df.groupBy(*keys, at).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    points = materialise(points, "points")
    block, within = F.floor(F.col(at) / size), F.pmod(F.col(at), size)
    here = points.filter(F.col(at).isNotNull()).select(*keys, F.col(at).alias("_at"), "_low", "_high", block.alias("_block"))
    # Who asks the block before for its end: everyone but the last place of a block, whose frame is its own block.
    ask = points.filter(within < width).select(
        *keys, (F.col(at) - width).alias("_at"), (block - 1).alias("_block"), F.lit(1).alias("_asks")
    )
    folds = {"_lowest": ("min", F.col("_low")), "_highest": ("max", F.col("_high"))}
    start = running(here, [*keys, "_block"], [F.col("_at")], folds, max_rows)
    both = here.withColumn("_asks", F.lit(0)).unionByName(ask, allowMissingColumns=True)
    end = running(both, [*keys, "_block"], [F.desc("_at"), F.col("_asks")], folds, max_rows).filter("_asks = 1")
    parts = start.select(*keys, "_at", "_lowest", "_highest").unionByName(
        end.select(*keys, (F.col("_at") + width).alias("_at"), "_lowest", "_highest")
    )
    found = parts.groupBy(*keys, F.col("_at").alias(at)).agg(F.min("_lowest").alias(low), F.max("_highest").alias(high))
    nowhere = points.filter(F.col(at).isNull()).select(*keys, at, F.col("_low").alias(low), F.col("_high").alias(high))
    return found.unionByName(nowhere)


def sliding_distinct(
    df: DataFrame, keys: Sequence[str], at: str, width: int, value: Column, name: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """keys, ``at`` and the number of distinct values in ``[at - width, at]``, for each distinct (group, at)."""
    keys = list(keys)
    placed = df.select(*keys, F.col(at).alias("_at"), value.alias("_value"))
    seen = materialise(placed.filter("_at IS NOT NULL AND _value IS NOT NULL").distinct(), "values")
    comes = previous(seen, [*keys, "_value"], "_at", "_before", max_rows)
    # Sides: 0 before the rows of a place, 1 the rows themselves, 2 after them.
    step = lambda place, side, by: F.struct(
        place.alias("_at"), F.lit(side).alias("_side"), F.lit(by).cast("bigint").alias("_by")
    )
    stays = F.col("_before") + width >= F.col("_at")
    enters = F.when(stays, step(F.col("_before") + width, 2, 1)).otherwise(step(F.col("_at"), 0, 1))
    leaves = step(F.col("_at") + width, 2, -1)
    steps = comes.select(*keys, F.explode(F.array(enters, leaves)).alias("s")).select(*keys, "s.*")
    steps = steps.groupBy(*keys, "_at", "_side").agg(F.sum("_by").alias("_by"))
    rows = placed.filter("_at IS NOT NULL").select(*keys, "_at").distinct()
    rows = rows.withColumns({"_side": F.lit(1), "_by": F.lit(0).cast("bigint")})
    run = running(steps.unionByName(rows), keys, [F.col("_at"), F.col("_side")], {name: ("sum", F.col("_by"))}, max_rows)
    found = run.filter("_side = 1").select(*keys, F.col("_at").alias(at), name)
    nowhere = placed.filter("_at IS NULL").groupBy(*keys).agg(F.count_distinct("_value").alias(name))
    return found.unionByName(nowhere.select(*keys, F.lit(None).cast("bigint").alias(at), name))


def moving_extremes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, rows: int, low: str, high: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the smallest and largest value over the current and the ``rows - 1`` earlier rows of the group.

    ``order`` must be total within a group. Frames of a few rows are Spark's own
    in ordinary groups.
    """
    keys = list(keys)
    cold, hot, _ = split_hot(df, keys, max_rows) if rows <= FEW_ROWS else (None, df, 0)
    done = None
    if cold is not None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, 0)
        done = cold.select("*", F.min(value).over(frame).alias(low), F.max(value).over(frame).alias(high))
        if hot is None:
            return done
    counted = numbered(hot.withColumn("_v", value), keys, [F.col(c) for c in order], "_rn", max_rows)
    counted = materialise(counted, "numbered")
    found = sliding_extremes(counted, keys, "_rn", rows - 1, F.col("_v"), low, high, max_rows)
    wanted = null_safe_join(counted, found, [*keys, "_rn"]).select(*df.columns, low, high)
    return wanted if done is None else done.unionByName(wanted)


def moving_distinct(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, rows: int, name: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the number of distinct values over the current and the ``rows - 1`` earlier rows of the group.

    ``order`` must be total within a group.
    """
    keys = list(keys)
    counted = numbered(df.withColumn("_v", value), keys, [F.col(c) for c in order], "_rn", max_rows)
    counted = materialise(counted, "numbered")
    found = sliding_distinct(counted, keys, "_rn", rows - 1, F.col("_v"), name, max_rows)
    return null_safe_join(counted, found, [*keys, "_rn"]).select(*df.columns, name)
