"""Array semantics that Spark's built-ins lack."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_offset(a: Column, value) -> Column:
    """0-based position of the first match, NULL when absent."""
    at = F.array_position(a, value)
    return F.when(at > 0, at - 1)


def array_offsets(a: Column, value) -> Column:
    """0-based positions of all matches."""
    marked = F.transform(a, lambda x, i: F.when(x == value, i))
    return F.filter(marked, lambda i: i.isNotNull())


def array_find(a: Column, keep) -> Column:
    """First element that ``keep`` accepts, NULL when none does."""
    return F.get(F.filter(a, keep), F.lit(0))


def array_is_distinct(a: Column) -> Column:
    return F.size(F.array_distinct(a)) == F.size(a)


def array_includes_all(a: Column, wanted: Column) -> Column:
    return F.size(F.array_except(wanted, a)) == 0


def array_sum(a: Column, kind: str = "double") -> Column:
    """Sum that skips NULLs; NULL for an array without values."""
    known = F.filter(a, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind))
    return F.when(F.size(known) > 0, total)


def array_avg(a: Column) -> Column:
    known = F.filter(a, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, array_sum(known) / F.size(known))
