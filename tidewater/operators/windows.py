"""Window functions that stay distributed when one group is very large.

Ordinary groups use Spark's window functions as they are. Groups above the row
limit (see ``skew``) are numbered in ordered slices; the window values are then
found by equi joins on (group, row number), which spread evenly.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.skew import MAX_GROUP_ROWS, null_safe_join, numbered, running_sums, split_hot
from tidewater.session import materialise


def ntile_of(rn: Column, total: Column, n: int) -> Column:
    """NTILE from a row number: the first ``total % n`` buckets get one extra row."""
    size, extra = F.floor(total / n), total % n
    wide = extra * (size + 1)
    return F.when(rn <= wide, F.ceil(rn / (size + 1))).otherwise(extra + F.ceil((rn - wide) / size)).cast("int")


def ranks(
    df: DataFrame, keys: Sequence[str], value: str, tie: str, tiles: int = 4, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add row_number, rank, dense_rank, percent_rank, cume_dist and ntile per group.

    Ranks compare ``value``; ``tie`` (unique within a group) orders equal values
    for row_number and ntile.
    """
    keys = list(keys)
    cold, hot, _ = split_hot(df, keys, max_rows)
    by_value = Window.partitionBy(*keys).orderBy(value)
    by_row = Window.partitionBy(*keys).orderBy(value, tie)
    done = cold.select(
        "*",
        F.row_number().over(by_row).cast("bigint").alias("row_number"),
        F.rank().over(by_value).cast("bigint").alias("rank"),
        F.dense_rank().over(by_value).cast("bigint").alias("dense_rank"),
        F.percent_rank().over(by_value).alias("percent_rank"),
        F.cume_dist().over(by_value).alias("cume_dist"),
        F.ntile(tiles).over(by_row).alias("ntile"),
    )
    if hot is None:
        return done
    # Ranks depend on the distinct values only, so equal values are counted first.
    values = hot.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_sums(
        values, keys, [F.col(value)], {"_upto": F.col("_n"), "dense_rank": F.lit(1).cast("bigint")}, max_rows
    )
    totals = values.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    per_value = null_safe_join(upto, totals, keys)
    rows = numbered(hot, keys, [F.col(value), F.col(tie)], "row_number", max_rows)
    rank = F.col("_upto") - F.col("_n") + 1
    joined = null_safe_join(rows, per_value, [*keys, value])
    return done.unionByName(
        joined.select(
            *df.columns,
            "row_number",
            rank.alias("rank"),
            "dense_rank",
            F.when(F.col("_total") > 1, (rank - 1) / (F.col("_total") - 1)).otherwise(0.0).alias("percent_rank"),
            (F.col("_upto") / F.col("_total")).alias("cume_dist"),
            ntile_of(F.col("row_number"), F.col("_total"), tiles).alias("ntile"),
        )
    )


def navigate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    nth: int = 2,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add lag, lead, first, last, nth and last-known value of ``value`` per group.

    ``order`` must be total within a group. ``last_known`` is LAST_VALUE IGNORE
    NULLS up to the current row; the others respect NULLs.
    """
    keys = list(keys)
    cold, hot, _ = split_hot(df, keys, max_rows)
    ordered = Window.partitionBy(*keys).orderBy(*order)
    full = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    done = cold.select(
        "*",
        F.lag(value).over(ordered).alias("lag_value"),
        F.lead(value).over(ordered).alias("lead_value"),
        F.first_value(value).over(full).alias("first_value"),
        F.last_value(value).over(full).alias("last_value"),
        F.nth_value(value, nth).over(full).alias("nth_value"),
        F.last_value(value, ignoreNulls=True).over(so_far).alias("last_known"),
    )
    if hot is None:
        return done
    known = {"_rn": F.lit(1).cast("bigint"), "_known": F.col(value).isNotNull().cast("bigint")}
    rows = materialise(running_sums(hot, keys, [F.col(c) for c in order], known, max_rows), "numbered")
    at = lambda shift, name: rows.select(*keys, (F.col("_rn") + shift).alias("_rn"), F.col(value).alias(name))
    ends = rows.groupBy(*keys).agg(
        F.min_by(value, "_rn").alias("first_value"),
        F.max_by(value, "_rn").alias("last_value"),
        F.max(F.when(F.col("_rn") == nth, F.col(value))).alias("nth_value"),
    )
    filled = rows.filter(F.col(value).isNotNull()).select(*keys, "_known", F.col(value).alias("last_known"))
    joined = null_safe_join(rows, at(1, "lag_value"), [*keys, "_rn"], "left")
    joined = null_safe_join(joined, at(-1, "lead_value"), [*keys, "_rn"], "left")
    joined = null_safe_join(joined, ends, keys)
    joined = null_safe_join(joined, filled, [*keys, "_known"], "left")
    return done.unionByName(joined.select(*done.columns))


def moving_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, rows: int, name: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the sum of ``value`` over the current and the ``rows - 1`` earlier rows of the group.

    A hot group is cut into slices of numbered rows; a slice also gets the
    ``rows - 1`` rows before it, so every frame lies in one slice and is summed
    by Spark's own window.
    """
    keys = list(keys)
    cold, hot, _ = split_hot(df, keys, max_rows)
    frame = lambda *by: Window.partitionBy(*by).rowsBetween(1 - rows, 0)
    done = cold.withColumn(name, F.sum(value).over(frame(*keys).orderBy(*order)))
    if hot is None:
        return done
    size = max(max_rows, rows)
    at = F.col("_rn") - 1
    counted = materialise(numbered(hot, keys, [F.col(c) for c in order], "_rn", max_rows), "numbered")
    own = counted.withColumns({"_slice": F.floor(at / size), "_halo": F.lit(False)})
    halo = counted.filter(at % size >= size - rows + 1).withColumns({"_slice": F.floor(at / size) + 1, "_halo": F.lit(True)})
    summed = own.unionByName(halo).withColumn(name, F.sum(value).over(frame(*keys, "_slice").orderBy("_rn")))
    return done.unionByName(summed.filter("NOT _halo").select(*done.columns))


def sliding_totals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    width: str,
    sums: Mapping[str, Column],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Totals over the time range [ts - width, ts] for each distinct (group, ts).

    Rows of equal time are added up first; then Spark's own RANGE frame. A hot
    group is cut into slices of numbered times; a slice also gets the times up
    to ``width`` before its first one, so every frame lies in one slice.
    """
    keys = list(keys)
    at = materialise(df.groupBy(*keys, ts).agg(*[F.sum(c).alias(n) for n, c in sums.items()]), "totals")
    names = [*keys, ts, *sums]
    # NULL times form a frame of their own, as in any RANGE frame.
    framed = lambda by: [
        F.expr(
            f"sum({n}) OVER (PARTITION BY {', '.join(f'`{k}`' for k in by)} ORDER BY `{ts}` "
            f"RANGE BETWEEN INTERVAL {width} PRECEDING AND CURRENT ROW)"
        ).cast(at.schema[n].dataType).alias(n)
        for n in sums
    ]
    cold, hot, _ = split_hot(at, keys, max_rows)
    done = cold.select(*keys, ts, *framed(keys))
    if hot is None:
        return done
    counted = numbered(hot, keys, [F.col(ts)], "_rn", max_rows).withColumn("_slice", F.floor((F.col("_rn") - 1) / max_rows))
    counted = materialise(counted, "numbered")
    # Per hot group as many entries as it has slices.
    starts = counted.groupBy(*keys, "_slice").agg(F.min(ts).alias("start")).groupBy(*keys).agg(
        F.collect_list(F.struct("_slice", "start")).alias("_starts")
    )
    ahead = F.filter(
        "_starts", lambda s: (s["_slice"] > F.col("_slice")) & (s["start"] - F.expr(f"INTERVAL {width}") <= F.col(ts))
    )
    placed = null_safe_join(counted, starts, keys)
    halo = placed.withColumn("_slice", F.explode(F.transform(ahead, lambda s: s["_slice"]))).withColumn("_halo", F.lit(True))
    both = counted.withColumn("_halo", F.lit(False)).select(*names, "_slice", "_halo").unionByName(halo.select(*names, "_slice", "_halo"))
    summed = both.select(*keys, ts, "_halo", *framed([*keys, "_slice"]))
    return done.unionByName(summed.filter("NOT _halo").select(*done.columns))
