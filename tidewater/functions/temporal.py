"""Date and time semantics that differ from Spark's own functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "week": 604800}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def trunc_to(part: str, ts: Column) -> Column:
    """Truncate a timestamp without zone and keep it without zone. Weeks start on Monday."""
    return F.date_trunc(part, ts).cast("timestamp_ntz")


def boundary_diff(part: str, later: Column, earlier: Column) -> Column:
    """How many ``part`` boundaries lie between two timestamps (not whole elapsed units)."""
    if part in _MONTHS:
        months = lambda c: F.year(c) * 12 + F.month(c) - 1
        step = _MONTHS[part]
        return (F.floor(months(later) / step) - F.floor(months(earlier) / step)).cast("bigint")
    if part == "day":
        return F.date_diff(later, earlier).cast("bigint")
    seconds = lambda c: F.unix_seconds(F.date_trunc(part, c))
    return ((seconds(later) - seconds(earlier)) / _SECONDS[part]).cast("bigint")


def time_text(ts: Column) -> Column:
    """Time of day as ``HH:mm:ss.SSSSSS`` text."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def unix_micros_ntz(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, taken as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


DAY_MICROS = 86_400_000_000
_UNIT_MICROS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def time_micros(t: Column) -> Column:
    """Microseconds of a time of day since midnight."""
    midnight = F.make_time(F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"))
    return F.time_diff(F.lit("MICROSECOND"), midnight, t)


def time_of(micros: Column) -> Column:
    """The time of day so many microseconds after midnight, any number of days on or back."""
    left = F.pmod(micros, F.lit(DAY_MICROS))
    seconds = F.pmod(left, F.lit(60_000_000)).cast("decimal(14,0)") / F.lit(1_000_000)
    part = lambda unit, size: F.pmod(F.floor(left / F.lit(unit)), F.lit(size)).cast("int")
    return F.make_time(part(3_600_000_000, 24), part(60_000_000, 60), seconds.cast("decimal(8,6)"))


def time_add(t: Column, n: Column, part: str) -> Column:
    """A time of day ``n`` parts later (earlier where negative); it goes on past midnight."""
    return time_of(time_micros(t) + n.cast("bigint") * F.lit(_UNIT_MICROS[part]))


def format_time(pattern: str, t: Column) -> Column:
    """A time of day as text by a pattern of letters for hours, minutes, seconds and halves of the day."""
    if set(pattern) & set("yuMLdDQqEeYwWF"):
        raise ValueError("a time of day has no date parts")
    return F.date_format(F.make_timestamp_ntz(date=F.lit("1970-01-01").cast("date"), time=t), pattern)


def justify_interval(months: Column, days: Column, hours: Column) -> tuple[Column, Column, Column]:
    """(months, days, hours) of one sign, with whole days of 24 hours and whole months of 30 days carried over."""
    whole = (months * 30 + days) * 24 + hours
    sign, size = F.signum(whole).cast("bigint"), F.abs(whole)
    part = lambda unit, wrap: sign * (F.floor(size / unit) % wrap if wrap else F.floor(size / unit))
    return part(720, None), part(24, 30), sign * (size % 24)


def justify_hours(hours: Column) -> tuple[Column, Column]:
    """(days, hours) with whole 24-hour days carried over."""
    days = F.signum(hours).cast("bigint") * F.floor(F.abs(hours) / 24)
    return days, hours - days * 24


def justify_days(days: Column) -> tuple[Column, Column]:
    """(months, days) with whole 30-day months carried over."""
    months = F.signum(days).cast("bigint") * F.floor(F.abs(days) / 30)
    return months, days - months * 30
