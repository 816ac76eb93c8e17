"""Small relational operators on top of the DataFrame API."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.skew import MAX_GROUP_ROWS, null_safe_join, running_sums, salted_join
from tidewater.session import materialise


def group_implicit(df: DataFrame, plain: Mapping[str, Column], aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregate with no stated keys: every plain output becomes a key."""
    if not plain:
        return df.agg(*[c.alias(n) for n, c in aggregates.items()])
    keys = [c.alias(n) for n, c in plain.items()]
    if not aggregates:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def sort_by(df: DataFrame, *order: tuple[str, str]) -> DataFrame:
    """Sort by output alias; NULLs go last in either direction."""
    return df.orderBy(
        *[F.col(n).desc_nulls_last() if how == "desc" else F.col(n).asc_nulls_last() for n, how in order]
    )


def band_join(
    points: DataFrame,
    bands: DataFrame,
    value: str,
    low: str,
    high: str,
    width: float,
    how: str = "inner",
) -> DataFrame:
    """Join each point to every band with ``low <= value < high``.

    A non-equi predicate turned into an equi join: both sides get the number of
    the bucket of ``width`` they fall in (a band, each bucket it touches), then
    the exact predicate decides. Choose a width near the usual band length; a
    band much longer than that uses coarser buckets (see ``bucket_level``), so
    no band is copied more than a fixed number of times. A point has one bucket
    per level, so no pair is found twice. Crowded buckets are salted. ``how`` is
    inner or left_semi.
    """
    bucket = lambda c: F.floor(F.col(c) / F.lit(width)).cast("bigint")
    right = bands.filter(F.col(low) < F.col(high)).withColumns({"_first": bucket(low), "_last": bucket(high)})
    right = right.withColumn("_level", bucket_level("_first", "_last"))
    right = right.withColumn("_bucket", F.explode(touched_buckets("_first", "_last", F.col("_level")))).drop("_first", "_last")
    # As many rows as there are levels.
    levels = sorted(r["_level"] for r in right.select("_level").distinct().collect())
    left = points.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    left = left.withColumn("_bucket", at_level(bucket(value), F.col("_level")))
    inside = (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    if how == "left_semi":
        row = "_row_of_points"
        numbered = points.withColumn(row, F.xxhash64(*points.columns))
        found = band_join(numbered, bands, value, low, high, width).select(row, *points.columns).distinct()
        on = [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [row, *points.columns]]
        return numbered.alias("p").join(found.alias("f"), reduce(lambda x, y: x & y, on), "left_semi").drop(row)
    return salted_join(left, right, ["_level", "_bucket"]).filter(inside).drop("_level", "_bucket")


# Buckets of one level that a range may touch; each level's buckets are as many times as wide as the one before.
FAN = 64


def bucket_level(first: str, last: str) -> Column:
    """The finest level at which a range from bucket ``first`` to ``last`` touches few buckets."""
    level = F.lit(10)
    for x in reversed(range(10)):
        level = F.when(F.col(last) - F.col(first) <= FAN ** (x + 1), x).otherwise(level)
    return level.cast("int")


def at_level(bucket: Column, level: Column) -> Column:
    """The bucket of a coarser level that holds a bucket of level 0."""
    return F.call_function("shiftright", bucket, level * 6)  # FAN is 2 ** 6


def touched_buckets(first: str, last: str, level: Column) -> Column:
    """All buckets of ``level`` from ``first`` to ``last``."""
    return F.sequence(at_level(F.col(first), level), at_level(F.col(last), level))


def left_join_hot(left: DataFrame, right: DataFrame, on: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Left join for a right side that may have hot keys.

    Spark cannot split a hot key on the right of an outer join. Where the right
    side has none, this is a plain left join. Otherwise rows of hot keys are
    joined apart: all of them have a match, so theirs is an inner join, which
    Spark can split.
    """
    on = list(on)
    counts = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialise(counts.filter(F.col("_n") > max_rows).select(*on), "hot-keys")
    if hot.isEmpty():
        return left.join(right, on, "left")
    cold = left.join(hot, on, "left_anti").join(right.join(hot, on, "left_anti"), on, "left")
    matched = left.join(hot, on, "left_semi").join(right, on)
    return cold.unionByName(matched)


def rank_at_most(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Top ``k`` rows of each group.

    Written as a row_number filter, which Spark runs as a group limit before
    the shuffle: each task sends at most ``k`` rows per group, hot groups too.
    """
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn", rn).filter(F.col("rn") <= k)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float], max_rows: int | None = None
) -> DataFrame:
    """Exact percentiles per group, continuous (``name``) and discrete (``name_disc``).

    Equal values are counted before anything is ordered, and ordered totals are
    carried across slices of hot groups, so no group has to fit in one task.
    """
    if not keys:
        everything = df.withColumn("_all", F.lit(0))
        return exact_percentiles(everything, ["_all"], value, fractions, max_rows).drop("_all")
    keys = list(keys)
    counted = materialise(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")), "value-counts"
    )
    extra = {} if max_rows is None else {"max_rows": max_rows}
    upto = running_sums(counted, keys, [F.col(value)], {"_upto": F.col("_n")}, **extra)
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    ranked = null_safe_join(upto, totals, keys)
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1  # 0-based positions of this value
    picks = []
    for name, p in fractions.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        for label, position in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            picks.append(F.max(F.when((first <= position) & (position <= last), F.col(value))).alias(f"_{name}_{label}"))
        at = F.greatest(F.ceil(F.col("_total") * F.lit(float(p))), F.lit(1)) - 1
        picks.append(F.max(F.when((first <= at) & (at <= last), F.col(value))).alias(f"{name}_disc"))
    found = ranked.groupBy(*keys, "_total").agg(*picks)
    out = []
    for name, p in fractions.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        part = spot - F.floor(spot)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out += [(lo + (hi - lo) * part).alias(name), F.col(f"{name}_disc")]
    return found.select(*keys, *out)
