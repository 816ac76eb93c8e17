"""Group-wise work that holds when one group has a large share of all rows.

Spark's own aggregates combine before the shuffle and adaptive execution splits
skewed inner joins. What is left are ordered computations inside a group
(windows), which Spark runs in one task per group. The functions here find the
groups that are too large for that, cut only those into ordered slices, work on
the slices, and carry totals across slices.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialise

MAX_GROUP_ROWS = 4_000_000
# Candidate pairs one task of a join may look at, per row of the limit above.
PAIRS_PER_ROW = 16


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on group keys in which NULL is a key like any other, as in GROUP BY and windows."""
    renamed = right.select(
        *[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_j_{k}" for k in keys])


def split_hot(
    df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary groups, rows of groups above ``max_rows`` or None, hot row count).

    The list of hot keys has at most ``rows / max_rows`` entries. It is written
    out, so the joins below choose broadcast or shuffle by its real size.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot_keys = materialise(counts.filter(F.col("_n") > max_rows), "hot-keys")
    hot_rows = hot_keys.agg(F.sum("_n")).first()[0]
    if not hot_rows:
        return df, None, 0
    on = _same_keys("d", "h", keys)
    cold = df.alias("d").join(hot_keys.alias("h"), on, "left_anti")
    hot = df.alias("d").join(hot_keys.alias("h"), on, "left_semi")
    return cold, hot, int(hot_rows)


# How a running value folds rows, and how the value of earlier slices joins that of a row's own.
FOLDS = {
    "sum": (F.sum, lambda own, before: own + before),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add inclusive running sums within each group, in ``order`` (which must be total)."""
    return running(df, keys, order, {n: ("sum", c) for n, c in sums.items()}, max_rows)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    folds: Mapping[str, tuple[str, Column]],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add inclusive running values (``sum``, ``min`` or ``max`` of a column) within each group, in ``order``.

    The order must be total where a row's value depends on it. Ordinary groups
    use one window. Hot groups, or the whole frame when there are no keys, are
    range-partitioned on (keys, order); each slice gets a local window and the
    folded values of the slices before it. NULLs are passed over.
    """
    keys = list(keys)
    over = lambda w: [FOLDS[how][0](c).over(w).alias(n) for n, (how, c) in folds.items()]
    if keys:
        cold, hot, hot_rows = split_hot(df, keys, max_rows)
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        done = cold.select("*", *over(whole))
        if hot is None:
            return done
    else:
        done, hot = None, materialise(df, "ungrouped")
        hot_rows = hot.count()  # from file footers
        if hot_rows <= max_rows:
            whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            return hot.select("*", *over(whole))

    slices = hot_rows // max_rows + 1
    types = {n: df.select(FOLDS[how][0](c).alias("x")).schema["x"].dataType for n, (how, c) in folds.items()}
    ranged = hot.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
    sliced = materialise(
        ranged.select(
            "*",
            F.spark_partition_id().alias("_slice"),
            *[c.alias(f"_in_{n}") for n, (_, c) in folds.items()],
        ),
        "slices",
    )
    local = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    # One row per (group, slice): at most a few rows per slice, so a window over
    # the slices of a group stays small.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[FOLDS[how][0](f"_in_{n}").alias(f"_t_{n}") for n, (how, _) in folds.items()]
    )
    before = totals.select(
        *keys, "_slice", *[FOLDS[how][0](f"_t_{n}").over(earlier).alias(f"_b_{n}") for n, (how, _) in folds.items()]
    )
    joined = (
        sliced.select("*", *[FOLDS[how][0](f"_in_{n}").over(local).alias(f"_l_{n}") for n, (how, _) in folds.items()])
        .alias("d")
        .join(before.alias("b"), _same_keys("d", "b", [*keys, "_slice"]))
    )

    def carried(n: str) -> Column:
        """Local and carried part; NULL only where neither holds a value."""
        own, before = F.col(f"_l_{n}"), F.col(f"_b_{n}")
        return F.when(own.isNull(), before).when(before.isNull(), own).otherwise(FOLDS[folds[n][0]][1](own, before))

    wanted = joined.select(
        *[F.col(f"d.{c}") for c in df.columns], *[carried(n).cast(types[n]).alias(n) for n in folds]
    )
    return wanted if done is None else done.unionByName(wanted)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rn",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """ROW_NUMBER within each group over a total order."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("bigint")}, max_rows)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Equi join whose hot keys are spread over several tasks.

    A key is hot by its ``big`` rows (above ``max_rows``) or by its candidate
    pairs, ``big`` rows times ``small`` rows (above ``PAIRS_PER_ROW`` times
    that). Its ``big`` rows are dealt over salts by a hash of ``salt_by``
    (repeatable, so a retried task deals them the same way); the matching
    ``small`` rows are repeated once per salt. ``how`` may be inner, left or
    left_semi/left_anti, all of which keep ``big`` rows exactly once.
    """
    on = list(on)
    tally = lambda df, n: df.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
    counts = tally(big, "_n").join(tally(small, "_m"), on, "left")
    salts = F.ceil(
        F.greatest(
            F.col("_n") / F.lit(max_rows),
            F.col("_n").cast("double") * F.coalesce("_m", F.lit(0)) / F.lit(float(max_rows * PAIRS_PER_ROW)),
        )
    )
    # No more salts than there are rows to deal.
    counts = counts.withColumn("_salts", F.least(salts, F.col("_n")).cast("int"))
    hot = materialise(counts.filter("_salts > 1").select(*on, "_salts"), "hot-keys")
    if hot.isEmpty():
        return big.join(small, on, how)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    hashed = F.xxhash64(*[F.col(c) for c in (salt_by or big.columns)])
    dealt = big.join(hot, on, "left").withColumn("_salt", F.pmod(hashed, salts).cast("int")).drop("_salts")
    copied = (
        small.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return dealt.join(copied, [*on, "_salt"], how).drop("_salt")
