"""Numeric semantics that differ from Spark's own functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widths of the unsigned types.
TWO_32 = 4294967296
TWO_64 = "18446744073709551616"


def ieee_divide(x: Column, y: Column) -> Column:
    """x / y on doubles with IEEE results for a zero divisor: ±Infinity, or NaN for 0/0."""
    x, y = x.cast("double"), y.cast("double")
    by_zero = (
        F.when((x == 0) | F.isnan(x), F.lit(float("nan")))
        .when(x > 0, F.lit(float("inf")))
        .when(x < 0, F.lit(float("-inf")))
    )
    return F.when(y == 0, by_zero).otherwise(F.try_divide(x, y))


def is_inf(x: Column) -> Column:
    return F.abs(x) == F.lit(float("inf"))


def safe_negate(x: Column) -> Column:
    """-x, or NULL where the type cannot hold it."""
    return safe_subtract(F.lit(0), x)


def _in_bigint(exact: Column) -> Column:
    """A wide decimal as bigint, NULL outside its range."""
    low, high = (F.lit(v).cast("decimal(19,0)") for v in ("-9223372036854775808", "9223372036854775807"))
    return F.when(exact.between(low, high), exact.cast("bigint"))


def safe_add(x: Column, y: Column) -> Column:
    """x + y on 64-bit integers, NULL on overflow.

    Computed in decimals: the try_ functions raise and catch an error for each
    overflowing row, which is very slow when there are many.
    """
    return _in_bigint(x.cast("decimal(19,0)") + y.cast("decimal(19,0)"))


def safe_subtract(x: Column, y: Column) -> Column:
    return _in_bigint(x.cast("decimal(19,0)") - y.cast("decimal(19,0)"))


def safe_multiply(x: Column, y: Column) -> Column:
    return _in_bigint(x.cast("decimal(19,0)") * y.cast("decimal(19,0)"))


def _shift(x: Column, by: Column, bits: int, shift: str) -> Column:
    """Shift with the declared edge rules: negative is an error, the width or more gives 0."""
    kind = "bigint" if bits == 64 else "int"
    shifted = F.call_function(shift, x.cast(kind), F.least(by, F.lit(bits - 1)).cast("int"))
    return (
        F.when(by < 0, F.raise_error(F.lit("shift by a negative amount")).cast(kind))
        .when(by >= bits, F.lit(0).cast(kind))
        .otherwise(shifted)
    )


def shift_left(x: Column, by: Column, bits: int = 64) -> Column:
    return _shift(x, by, bits, "shiftleft")


def shift_right(x: Column, by: Column, bits: int = 64) -> Column:
    """Without sign extension."""
    return _shift(x, by, bits, "shiftrightunsigned")


def trunc_digits(x: Column, digits: int = 0) -> Column:
    """Cut towards zero after ``digits`` decimals (for decimal input, exact)."""
    scale = 10**digits
    return F.signum(x).cast("int") * F.floor(F.abs(x) * F.lit(scale)) / F.lit(scale)


def extremum(pick, *columns: Column) -> Column:
    """``F.greatest`` or ``F.least`` that is NULL as soon as one input is NULL."""
    any_null = columns[0].isNull()
    for c in columns[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, pick(*columns))


def range_bucket(x: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` are at or below x."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= x))


def uint32_to_int32(x: Column) -> Column:
    """Same 32 bits, read as signed."""
    return F.when(x >= TWO_32 // 2, x - F.lit(TWO_32)).otherwise(x).cast("int")


def int32_to_uint32(x: Column) -> Column:
    x = x.cast("bigint")
    return F.when(x < 0, x + F.lit(TWO_32)).otherwise(x)


def uint64_to_int64(x: Column) -> Column:
    """Same 64 bits, read as signed; unsigned values are decimal(20,0)."""
    x = x.cast("decimal(20,0)")
    half = F.lit("9223372036854775808").cast("decimal(20,0)")
    return F.when(x >= half, x - F.lit(TWO_64).cast("decimal(20,0)")).otherwise(x).cast("bigint")


def int64_to_uint64(x: Column) -> Column:
    x = x.cast("decimal(20,0)")
    return F.when(x < 0, x + F.lit(TWO_64).cast("decimal(20,0)")).otherwise(x).cast("decimal(20,0)")


def fixed(amount: Column, digits: int = 2) -> Column:
    """A double rounded half up to ``digits`` decimals, as a whole number of its smallest unit.

    An amount that is a whole number of units takes the cheap way; any other is
    rounded as a decimal, so 0.125 gives 13 and 1.005 gives 101. NaN, infinity
    and amounts whose units do not fit 64 bits fail the query: no amount drops
    out of a sum unseen. NULL stays NULL.
    """
    scale = F.lit(float(10**digits))
    units = F.rint(amount * scale)
    whole = (units / scale == amount) & (F.abs(units) < F.lit(float(1 << 53)))
    by_decimal = amount.cast(f"decimal(38,{digits})") * F.lit(10**digits).cast("decimal(18,0)")
    # NaN and infinity come out of the cast as NULL.
    no_number = F.when(amount.isNotNull(), F.raise_error(F.lit("OUT_OF_RANGE: an amount must be a finite number")).cast("bigint"))
    return F.when(whole, units.cast("bigint")).otherwise(F.coalesce(by_decimal.cast("bigint"), no_number))


def sum_fixed(units: Column, digits: int = 2, out: str = "decimal(28,2)") -> Column:
    """Exact sum of ``fixed`` values as a decimal with ``digits`` decimals.

    Adds the upper and the lower bits apart as plain integers, so neither sum
    can overflow, and puts them together once per group.
    """
    low_bits = 20
    high = F.sum(F.shiftright(units, low_bits)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << low_bits) - 1))).cast("decimal(20,0)")
    total = high * F.lit(1 << low_bits).cast("decimal(7,0)") + low
    return (total * F.lit(f"{10**-digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")).cast(out)


def sum_interval(interval: Column) -> Column:
    """Exact sum of day-time intervals, in seconds as a decimal with six decimals.

    Spark adds intervals as 64-bit microseconds: some millions of rows of a few weeks overflow that.
    """
    return F.sum(interval.cast("interval second").cast("decimal(19,6)"))
