"""Joins and counts on ranges, without comparing every pair."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.relational import at_level, bucket_level, touched_buckets
from tidewater.operators.inequality import count_matches
from tidewater.operators.skew import MAX_GROUP_ROWS, null_safe_join, running, running_sums, salted_join

# Buckets to the width a join is told.
PARTS = 6


def make_range(start: Column, end: Column) -> Column:
    """Range value; a NULL end is unbounded, and a start after the end is an error."""
    bad = start.isNotNull() & end.isNotNull() & (start >= end)
    return F.when(bad, F.raise_error(F.lit("range start must be before its end"))).otherwise(
        F.struct(start.alias("start"), end.alias("end"))
    )


def count_below(
    points: DataFrame, point: str, values: DataFrame, value: str, inclusive: bool, name: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """For each distinct ``point``, how many ``values`` are below it (or equal, if inclusive).

    The count over a non-equi join, as one running sum over the merged values.
    """
    marks = values.groupBy(F.col(value).alias("_t")).agg(F.count(F.lit(1)).alias("_w"))
    asked = points.select(F.col(point).alias("_t")).distinct().withColumn("_w", F.lit(0).cast("bigint"))
    value_side, point_side = (0, 1) if inclusive else (1, 0)
    merged = marks.withColumn("_side", F.lit(value_side)).unionByName(asked.withColumn("_side", F.lit(point_side)))
    run = running_sums(
        merged.filter(F.col("_t").isNotNull()), [], [F.col("_t"), F.col("_side")], {name: F.col("_w")}, max_rows
    )
    return run.filter(F.col("_side") == point_side).select(F.col("_t").alias(point), name)


def _closed(df: DataFrame, start: str, end: str) -> DataFrame:
    """Bounds with the ends of time in place of NULL."""
    kind = df.schema[start].dataType
    never = lambda c, text: F.coalesce(F.col(c), F.lit(text).cast(kind))
    return df.withColumns({"_lo": never(start, "0001-01-01"), "_hi": never(end, "9999-12-31")})


def overlap_counts(
    left: DataFrame, right: DataFrame, start: str, end: str, name: str = "n_overlaps", max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add to each left range [start, end) the number of right ranges it overlaps.

    Overlapping = started before my end, minus ended at or before my start. No
    pair is ever built, so dense stretches cost no more than sparse ones. A NULL
    bound of a time range is unbounded.
    """
    left, right = _closed(left, start, end), _closed(right, start, end)
    started = count_below(left, "_hi", right, "_lo", False, "_started", max_rows)
    ended = count_below(left, "_lo", right, "_hi", True, "_ended", max_rows)
    return (
        left.join(started, "_hi")
        .join(ended, "_lo")
        .select(*[c for c in left.columns if c not in ("_lo", "_hi")], (F.col("_started") - F.col("_ended")).alias(name))
    )


def containers(
    left: DataFrame, right: DataFrame, start: str, end: str, key: str, name: str = "container",
    within: Sequence[str] = (), max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add to each left time range the ``key`` of a right range that holds it, NULL if none does.

    Of the right ranges that start no later, the one that ends last decides: it
    holds the left range, or none of them does (ties: the largest key). That is
    a running maximum over the starts, so no pair is built and a stretch that
    many ranges cover costs no more than any other. ``within`` names columns
    that must agree (NULL agrees with NULL). A NULL bound is unbounded.
    """
    within = list(within)
    left, right = _closed(left, start, end), _closed(right, start, end)
    reach = F.struct(F.col("_hi").alias("end"), F.col(key).alias("key"))
    starts = right.groupBy(*within, F.col("_lo").alias("_t")).agg(F.max(reach).alias("_reach"))
    asked = left.select(*within, F.col("_lo").alias("_t")).distinct().withColumn("_side", F.lit(1))
    merged = starts.withColumn("_side", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    run = running(merged, within, [F.col("_t"), F.col("_side")], {"_furthest": ("max", F.col("_reach"))}, max_rows)
    furthest = run.filter("_side = 1").select(*within, F.col("_t").alias("_lo"), "_furthest")
    joined = null_safe_join(left, furthest, [*within, "_lo"])
    kept = [c for c in left.columns if c not in ("_lo", "_hi")]
    return joined.select(*kept, F.when(F.col("_furthest.end") >= F.col("_hi"), F.col("_furthest.key")).alias(name))


def container_counts(
    left: DataFrame, right: DataFrame, start: str, end: str, name: str = "n_containers", max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add to each left time range the number of right ranges that hold it: start no later, end no earlier."""
    left, right = _closed(left, start, end), _closed(right, start, end)
    counted = count_matches(left, right, ("_lo", ">=", "_lo"), ("_hi", "<=", "_hi"), name, max_rows=max_rows)
    return counted.drop("_lo", "_hi")


def laid_on_buckets(
    left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], width: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``overlap_join`` with _left_holds, _level and _bucket, by which holders meet starts."""
    step = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + INTERVAL {width})") / PARTS
    slot = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / step).cast("bigint")
    far = 1 << 50  # beyond every bucket of a time

    def with_slots(df: DataFrame, start: str, end: str) -> DataFrame:
        kept = df.filter(F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < F.col(end)))
        last = slot(F.col(end) - F.expr("INTERVAL 1 MICROSECOND"))
        marked = kept.withColumns(
            {"_first": F.coalesce(slot(F.col(start)), F.lit(-far)), "_last": F.coalesce(last, F.lit(far))}
        )
        return marked.withColumn("_own", bucket_level("_first", "_last"))

    a, b = with_slots(left, *left_range), with_slots(right, *right_range)
    # At most as many rows as there are levels, for either side.
    used = a.select(F.lit(True).alias("l"), "_own").unionByName(b.select(F.lit(False).alias("l"), "_own")).distinct().collect()

    def spread(df: DataFrame, is_left: bool) -> DataFrame:
        """Rows as holders on all they touch at their own level, then as starts at each level of the other side's holders."""
        levels = [F.lit(r["_own"]).cast("int") for r in used if r["l"] != is_left]
        touched = touched_buckets("_first", "_last", F.col("_own"))
        starts = [at_level(F.col("_first"), level) for level in levels]
        at = df.select("*", F.posexplode(F.concat(touched, F.array(*starts)) if starts else touched).alias("_at", "_bucket"))
        beyond = F.col("_at") - (at_level(F.col("_last"), F.col("_own")) - at_level(F.col("_first"), F.col("_own")))
        level = F.when(beyond <= 0, F.col("_own"))
        for k, other in enumerate(levels):
            level = level.when(beyond == k + 1, other)
        return at.withColumns({"_left_holds": (beyond <= 0) == F.lit(is_left), "_level": level}).drop("_at", "_first", "_last", "_own")

    return spread(a, True), spread(b, False)


def overlap_join(
    left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], width: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Pairs of overlapping [start, end) time ranges; a NULL bound is unbounded.

    Of two overlapping ranges one holds the start of the other (of equal starts,
    the left range does), so every range is laid, as a holder, on the buckets it
    touches, and its start, as a point, on one bucket; holders meet the other
    side's points by bucket. Buckets are a sixth of ``width``: few candidates of a
    range about that long are no pairs, and no pair is found twice. A range much
    longer than that lies on coarser buckets, and points go to every level the
    other side's holders use. Crowded buckets are salted.
    """
    (ls, le), (rs, re) = left_range, right_range
    a, b = laid_on_buckets(left, right, left_range, right_range, width)
    # The pairs, not the bytes, are the work: merged by bucket it is dealt to many tasks however small the tables are.
    pairs = salted_join(a, b.hint("merge"), ["_left_holds", "_level", "_bucket"], max_rows=max_rows)
    return pairs.filter(
        F.coalesce(F.col(ls) < F.col(re), F.lit(True))
        & F.coalesce(F.col(rs) < F.col(le), F.lit(True))
        & (F.col("_left_holds") == F.coalesce(F.col(ls) <= F.col(rs), F.col(ls).isNull()))
    ).drop("_left_holds", "_level", "_bucket")
