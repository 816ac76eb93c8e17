"""Aggregates whose partial states are kept and merged, and sketches."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialise

# name -> (partial aggregate of a column, merge of partials)
MERGEABLE = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "count_if": (F.count_if, F.sum),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
    "logical_and": (F.bool_and, F.bool_and),
    "logical_or": (F.bool_or, F.bool_or),
    "bit_and": (F.bit_and, F.bit_and),
    "bit_or": (F.bit_or, F.bit_or),
    "bit_xor": (F.bit_xor, F.bit_xor),
    "hll": (F.hll_sketch_agg, F.hll_union_agg),
    "set": (F.collect_set, lambda c: F.array_distinct(F.flatten(F.collect_set(c)))),
    # All values, duplicates kept. Give structs of (order, value): NULL values stay, and sorting
    # the merged list restores the order. A group's list must be bounded by the data.
    "list": (F.collect_list, lambda c: F.flatten(F.collect_list(c))),
}


def partial_rollup(df: DataFrame, keys: Sequence, parts: dict[str, tuple[str, Column]]) -> DataFrame:
    """One partial state per key, for storing: ``parts`` is name -> (aggregate, input)."""
    return df.groupBy(*keys).agg(*[MERGEABLE[a][0](c).alias(n) for n, (a, c) in parts.items()])


def merge_rollup(rollup: DataFrame, keys: Sequence, parts: dict[str, tuple[str, Column]]) -> DataFrame:
    """Merge stored partial states into coarser keys."""
    return rollup.groupBy(*keys).agg(*[MERGEABLE[a][1](F.col(n)).alias(n) for n, (a, _) in parts.items()])


def top_sum(df: DataFrame, value: str, total: Column, k: int) -> DataFrame:
    """The ``k`` values with the largest ``total`` (a sum of weights). Exact: one row per value after the shuffle."""
    totals = df.groupBy(value).agg(total.alias("total"))
    return totals.orderBy(F.desc("total"), F.asc(value)).limit(k)


def signed_distinct(df: DataFrame, keys: Sequence[str], value: str, sign: Column) -> DataFrame:
    """Distinct values per group that were added more often than deleted (exact)."""
    net = df.groupBy(*keys, value).agg(F.sum(sign).alias("_net")).filter(F.col("_net") > 0)
    return net.groupBy(*keys).agg(F.count(value).alias("n_distinct"))


# Day states one array of a fold may hold.
FOLD_FAN = 16


def daily_changes(
    df: DataFrame, keys: Sequence[str], day: Column, value: str, adds: Column, order: Sequence[Column]
) -> DataFrame:
    """One state per group and day, for storing: keys, day and two theta sketches, ``added`` and ``deleted``.

    What a day does to a value is its last change of that day in ``order``:
    ``adds`` true puts it in, false takes it out. A NULL value or NULL ``adds``
    changes nothing.
    """
    known = df.select(*keys, day.alias("day"), F.col(value).alias("_value"), adds.alias("_adds"), F.struct(*order).alias("_order"))
    known = known.filter("_value IS NOT NULL AND _adds IS NOT NULL")
    last = known.groupBy(*keys, "day", "_value").agg(F.max_by("_adds", "_order").alias("_adds"))
    return last.groupBy(*keys, "day").agg(
        F.expr("theta_sketch_agg(CASE WHEN _adds THEN _value END)").alias("added"),
        F.expr("theta_sketch_agg(CASE WHEN NOT _adds THEN _value END)").alias("deleted"),
    )


def fold_changes(states: DataFrame, keys: Sequence[str], order: str = "day", fan: int = FOLD_FAN) -> DataFrame:
    """Fold stored change states in their order into one per group: keys, ``added`` and ``deleted``.

    A state stands for "take out what is deleted, put in what is added". Two in a
    row are one such state again: the later one takes out of the earlier one's
    additions, then adds its own. That holds for any bracketing, so neighbours are
    folded ``fan`` at a time, in rounds, and states of any periods can be folded on.
    """
    keys = list(keys)
    # One row per group and period, which is what a stored roll-up has.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    rows = materialise(states.select(*keys, nth.alias("nth"), "added", "deleted"), "states")
    left = rows.agg(F.max("nth")).first()[0] or 0
    then = """aggregate(slice(s, 2, size(s)), named_struct('added', s[0].added, 'deleted', s[0].deleted), (a, x) -> named_struct(
                  'added', theta_union(theta_difference(a.added, x.deleted), x.added),
                  'deleted', theta_union(a.deleted, x.deleted)))"""
    while left > 0:
        chunk = F.floor(F.col("nth") / fan).cast("int").alias("nth")
        near = rows.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(F.struct("nth", "added", "deleted"))).alias("s"))
        rows = materialise(near.select(*keys, "nth", F.expr(then).alias("c")).select(*keys, "nth", "c.*"), "states")
        left //= fan
    return rows.select(*keys, "added", "deleted")
