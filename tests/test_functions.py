"""Column helpers at their edges."""
import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions import nested, numeric, temporal, text
from tidewater.operators.relational import group_implicit, sort_by


def value(spark, column, row="1 AS one"):
    return spark.sql(f"SELECT {row}").select(column.alias("x")).first()["x"]


def lit(v, t="bigint"):
    return F.lit(v).cast(t)


@pytest.mark.parametrize("by,want", [(0, 5), (1, 10), (63, -(2**63)), (64, 0), (1000, 0)])
def test_shift_left(spark, by, want):
    assert value(spark, numeric.shift_left(lit(5), F.lit(by))) == want


def test_shift_right_has_no_sign_extension(spark):
    assert value(spark, numeric.shift_right(lit(-1), F.lit(60))) == 15
    assert value(spark, numeric.shift_right(lit(-1, "int"), F.lit(31), 32)) == 1
    assert value(spark, numeric.shift_right(lit(-1, "int"), F.lit(32), 32)) == 0
    with pytest.raises(Exception, match="negative amount"):
        value(spark, numeric.shift_right(lit(1), F.lit(-1)))


@pytest.mark.parametrize("x,y,want", [(1, 0, math.inf), (-1, 0, -math.inf), (6, 4, 1.5)])
def test_ieee_divide(spark, x, y, want):
    assert value(spark, numeric.ieee_divide(F.lit(x), F.lit(y))) == want


def test_ieee_divide_nan(spark):
    assert math.isnan(value(spark, numeric.ieee_divide(F.lit(0), F.lit(0))))


def test_safe_negate(spark):
    assert value(spark, numeric.safe_negate(F.expr("-9223372036854775808L"))) is None
    assert value(spark, numeric.safe_negate(lit(4))) == -4


def test_extremum_is_null_when_any_is(spark):
    assert value(spark, numeric.extremum(F.greatest, lit(1), lit(None))) is None
    assert value(spark, numeric.extremum(F.least, lit(3), lit(2))) == 2


@pytest.mark.parametrize("x,want", [(-1, 0), (0, 1), (10, 2), (11, 2), (20, 3)])
def test_range_bucket(spark, x, want):
    assert value(spark, numeric.range_bucket(F.lit(x), [0, 10, 20])) == want


@pytest.mark.parametrize("x", [0, 1, 2**31 - 1, 2**31, 2**32 - 1])
def test_bit_casts_round_trip(spark, x):
    back = numeric.int32_to_uint32(numeric.uint32_to_int32(lit(x)))
    assert value(spark, back) == x
    big = F.lit(str(x * (2**32) + 7)).cast("decimal(20,0)")
    assert int(value(spark, numeric.int64_to_uint64(numeric.uint64_to_int64(big)))) == x * (2**32) + 7


def test_trunc_goes_towards_zero(spark):
    d = lambda s: F.lit(s).cast("decimal(18,4)")
    assert float(value(spark, numeric.trunc_digits(d("-1.2999"), 2))) == -1.29
    assert float(value(spark, numeric.trunc_digits(d("1.2999"), 0))) == 1.0


def test_sum_fixed_is_exact_beyond_64_bits(spark):
    big = spark.range(64).select(F.lit(9_000_000_000_000_000_000).alias("u"), F.col("id"))
    got = big.agg(numeric.sum_fixed(F.col("u"), 2, "decimal(38,2)").alias("s")).first()["s"]
    assert int(got * 100) == 64 * 9_000_000_000_000_000_000
    mixed = spark.createDataFrame([(-3.07,), (1.01,), (None,), (0.05,)], "x double")
    assert str(mixed.agg(numeric.sum_fixed(numeric.fixed(F.col("x")))).first()[0]) == "-2.01"


def test_instr(spark):
    s = F.lit("banana")
    assert [value(spark, text.instr(s, "ana", 1, n)) for n in (1, 2, 3)] == [2, 4, 0]
    assert value(spark, text.instr(s, "ana", 3)) == 4


def test_initcap_with_delimiters(spark):
    assert value(spark, text.initcap(F.lit("foo-bar bAZ"), "-")) == "Foo-Bar baz"
    assert value(spark, text.initcap(F.lit("foo-bar bAZ"), " -")) == "Foo-Bar Baz"


def test_split_is_literal(spark):
    assert value(spark, text.split_literal(F.lit("a.b|c."), ".")) == ["a", "b|c", ""]


def test_full_match(spark):
    assert value(spark, text.full_match(F.lit("abc"), "a|abc")) is True
    assert value(spark, text.full_match(F.lit("abcd"), "a|abc")) is False


@pytest.mark.parametrize(
    "part,want", [("year", 1), ("quarter", 1), ("month", 1), ("week", 1), ("day", 1), ("hour", 1), ("minute", 1)]
)
def test_boundary_diff_counts_boundaries(spark, part, want):
    earlier = F.lit("2023-12-31 23:59:59").cast("timestamp_ntz")
    later = F.lit("2024-01-01 00:00:01").cast("timestamp_ntz")
    assert value(spark, temporal.boundary_diff(part, later, earlier)) == want
    assert value(spark, temporal.boundary_diff(part, earlier, later)) == -want


def test_justify(spark):
    days, hours = temporal.justify_hours(lit(-49))
    assert (value(spark, days), value(spark, hours)) == (-2, -1)
    months, rest = temporal.justify_days(lit(65))
    assert (value(spark, months), value(spark, rest)) == (2, 5)


def test_array_helpers(spark):
    a = F.array(lit(4), lit(7), lit(4), lit(None))
    assert value(spark, nested.array_offset(a, F.lit(7))) == 1
    assert value(spark, nested.array_offset(a, F.lit(9))) is None
    assert value(spark, nested.array_offsets(a, F.lit(4))) == [0, 2]
    assert value(spark, nested.array_find(a, lambda x: x > 5)) == 7
    assert value(spark, nested.array_find(a, lambda x: x > 50)) is None
    assert value(spark, nested.array_is_distinct(a)) is False
    assert value(spark, nested.array_sum(a, "bigint")) == 15
    assert value(spark, nested.array_avg(a)) == 5.0
    assert value(spark, nested.array_sum(F.array(lit(None)), "bigint")) is None


def test_group_implicit(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "n int, s string")
    total = {"t": F.sum("n")}
    assert [tuple(r) for r in group_implicit(df, {}, total).collect()] == [(4,)]
    assert sorted(tuple(r) for r in group_implicit(df, {"s": F.col("s")}, total).collect()) == [("a", 3), ("b", 1)]
    assert group_implicit(df, {"n": F.col("n")}, {}).count() == 2


def test_sort_by_puts_nulls_last(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "n int")
    assert [r["n"] for r in sort_by(df, ("n", "asc")).collect()] == [1, 2, None]
    assert [r["n"] for r in sort_by(df, ("n", "desc")).collect()] == [2, 1, None]


@pytest.mark.parametrize("x,y", [(2**63 - 1, 1), (-(2**63), -1), (5, 7), (-3, 2**62), (2**62, 2), (-(2**62), 2), (None, 1)])
def test_safe_arithmetic(spark, x, y):
    fits = lambda v: v if v is not None and -(2**63) <= v < 2**63 else None
    a, b = lit(x), lit(y)
    assert value(spark, numeric.safe_add(a, b)) == (None if x is None else fits(x + y))
    assert value(spark, numeric.safe_subtract(a, b)) == (None if x is None else fits(x - y))
    assert value(spark, numeric.safe_multiply(a, b)) == (None if x is None else fits(x * y))


def test_fixed_rounds_half_up(spark):
    from tidewater.functions.numeric import fixed, sum_fixed

    values = [0.125, 1.005, 56.0123456789, -0.125, 2.675, 12345678901.23, 0.0, None, 9e16, -9e16]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["u"] for r in df.select(fixed(F.col("x")).alias("u")).collect()]
    assert got == [13, 101, 5601, -13, 268, 1234567890123, 0, None, 9 * 10**18, -9 * 10**18]
    rows = spark.range(2000).select((F.rand(3) * 1000).alias("x"))
    both = rows.agg(sum_fixed(fixed(F.col("x"))).alias("a"), F.sum(F.col("x").cast("decimal(18,2)")).cast("decimal(28,2)").alias("b")).first()
    assert both["a"] == both["b"]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), 1e17, -1e17, 1e300])
def test_no_amount_drops_out_of_a_sum(spark, bad):
    """An amount that cannot be held fails the query, also where the sum would hide it."""
    from tidewater.functions.numeric import fixed, sum_fixed

    df = spark.createDataFrame([(1.0,), (bad,), (2.5,), (None,)], "x double")
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|CAST_INVALID_INPUT|NUMERIC_VALUE"):
        df.agg(sum_fixed(fixed(F.col("x"))).alias("s")).collect()
    with pytest.raises(Exception):
        df.groupBy(F.col("x").isNull()).agg(sum_fixed(fixed(F.col("x"))), F.count("x")).collect()
    assert str(df.filter("x in (1.0, 2.5)").agg(sum_fixed(fixed(F.col("x")))).first()[0]) == "3.50"


def test_times_of_day_go_on_past_midnight(spark):
    t = lambda text: F.to_time(F.lit(text))
    text = lambda c: value(spark, c.cast("string"))
    assert text(temporal.time_add(t("23:10:00"), F.lit(90), "minute")) == "00:40:00"
    assert text(temporal.time_add(t("00:00:00.25"), F.lit(-500_000), "microsecond")) == "23:59:59.75"
    assert text(temporal.time_add(t("10:00:00"), F.lit(-49), "hour")) == "09:00:00"
    assert text(temporal.time_add(t("10:00:00"), F.lit(None).cast("int"), "hour")) is None


def test_format_time(spark):
    t = F.to_time(F.lit("15:04:05.5"))
    assert value(spark, temporal.format_time("hh:mm a", t)) == "03:04 PM"
    assert value(spark, temporal.format_time("HH-mm-ss.SSS", t)) == "15-04-05.500"
    with pytest.raises(ValueError):
        temporal.format_time("yyyy HH", t)


@pytest.mark.parametrize("given,want", [((0, 29, 49), (1, 1, 1)), ((1, 0, -1), (0, 29, 23)), ((0, -31, 0), (-1, -1, 0)), ((-1, 30, 0), (0, 0, 0)), ((0, 1, -25), (0, 0, -1))])
def test_justify_interval(spark, given, want):
    assert tuple(value(spark, c) for c in temporal.justify_interval(*[lit(x) for x in given])) == want


def test_arrays_of_long_conversations(spark, tmp_path):
    """A thousand turns are one row, with offsets that run through."""
    import __spark_entry__ as entry

    rows = spark.range(1000).selectExpr("7L AS conv_id", "999 - id AS turn", "if(id % 500 = 0, 'assistant', 'user') AS role", "'abc' AS text")
    rows.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = entry.queries()["arr_find"](spark, str(tmp_path)).collect()
    assert len(found) == 1 and found[0]["first_reply"] == 499 and found[0]["n_user"] == 998
    assert found[0]["user_turns"].split(",")[-1] == "998"
    one = entry.queries()["agg_array"](spark, str(tmp_path)).first()
    assert one["n_concat"] == 2000 and one["roles"].count(",") == 999
    assert entry.queries()["nested_build"](spark, str(tmp_path)).first()["turns"].count("turn") == 1000


def test_intervals_that_sum_beyond_64_bits(spark, tmp_path):
    """A hundred lags of ten thousand years are more microseconds than a long holds."""
    import __spark_entry__ as entry

    rows = spark.range(100).selectExpr(
        "7L AS l_orderkey", "'N' AS l_returnflag", "1.0D AS l_extendedprice", "0.0D AS l_tax",
        "if(id = 0, TIMESTAMP'0001-01-03 12:00:00', TIMESTAMP'9999-01-01 00:00:00') AS l_shipdate",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 7L AS o_orderkey, TIMESTAMP'0001-01-01 00:00:00' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    found = entry.queries()["agg_sum_avg"](spark, str(tmp_path)).first()
    days = 99 * 3_651_694 + 2  # and half a day
    assert found["sum_lag_days"] == days
    assert found["avg_lag_seconds"] == (days * 86_400 + 43_200) // 100
