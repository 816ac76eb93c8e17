"""Date and time queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.temporal import (
    boundary_diff,
    format_time,
    justify_days,
    justify_hours,
    justify_interval,
    time_add,
    time_text,
    trunc_to,
    unix_micros_ntz,
)
from tidewater.plans.registry import query
from tidewater.session import table

ISO = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


@query(
    "dt_now",
    "SELECT o_orderstatus, count(*) AS n_past, true AS clocks_agree FROM orders GROUP BY o_orderstatus",
)
def dt_now(spark, sf_dir):
    """Date, civil time and instant of one query agree, and every order lies before them (``dt_time`` has the fourth clock)."""
    agree = (F.localtimestamp().cast("date") == F.current_date()) & (
        F.date_format(F.current_timestamp(), "HH") == F.date_format(F.localtimestamp(), "HH")
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(
            F.count_if(F.col("o_orderdate") < F.localtimestamp()).alias("n_past"),
            F.bool_and(agree).alias("clocks_agree"),
        )
    )


@query(
    "dt_add_sub",
    """
    SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS plus_days, strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m-%d') AS minus_months,
           o_orderdate + INTERVAL 90 MINUTE AS plus_minutes, o_orderdate - INTERVAL 5 SECOND AS minus_seconds,
           strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%d') AS plus_year
    FROM orders
    """,
)
def dt_add_sub(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day(F.date_add(day, 10)).alias("plus_days"),
        _day(F.add_months(day, -2)).alias("minus_months"),
        F.expr("timestampadd(MINUTE, 90, o_orderdate)").alias("plus_minutes"),
        F.expr("timestampadd(SECOND, -5, o_orderdate)").alias("minus_seconds"),
        _day(F.expr("timestampadd(YEAR, 1, o_orderdate)")).alias("plus_year"),
    )


DIFF_PARTS = ["day", "week", "month", "quarter", "year", "hour", "minute"]
ANCHOR = "2024-01-15 13:45:30"


def _diff_sql(part: str) -> str:
    # Weeks are counted by their Mondays; the SQL engine's own week difference counts elapsed weeks.
    if part == "week":
        return (
            f"CAST(date_diff('day', date_trunc('week', TIMESTAMP '{ANCHOR}'), date_trunc('week', ts)) // 7 AS BIGINT) AS d_week"
        )
    return f"CAST(date_diff('{part}', TIMESTAMP '{ANCHOR}', ts) AS BIGINT) AS d_{part}"


@query(
    "dt_diff",
    "SELECT event_id, "
    + ", ".join(_diff_sql(p) for p in DIFF_PARTS)
    + " FROM events",
)
def dt_diff(spark, sf_dir):
    anchor = F.lit(ANCHOR).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id", *[boundary_diff(p, F.col("ts"), anchor).alias(f"d_{p}") for p in DIFF_PARTS]
    )


TRUNC_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


@query(
    "dt_trunc",
    "SELECT event_id, " + ", ".join(f"CAST(date_trunc('{p}', ts) AS TIMESTAMP) AS t_{p}" for p in TRUNC_PARTS) + " FROM events",
)
def dt_trunc(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", *[trunc_to(p, F.col("ts")).alias(f"t_{p}") for p in TRUNC_PARTS])


@query(
    "dt_epoch",
    """
    SELECT event_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS u_day,
           CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS u_sec, CAST(epoch_us(ts) // 1000 AS BIGINT) AS u_ms, epoch_us(ts) AS u_us,
           ts AS from_us, strftime(ts, '%Y-%m-%d') AS from_day, date_trunc('second', ts) AS from_sec
    FROM events
    """,
)
def dt_epoch(spark, sf_dir):
    """To epoch numbers and back."""
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_date(F.to_date("ts")).alias("u_day"),
        F.unix_seconds(instant).alias("u_sec"),
        F.unix_millis(instant).alias("u_ms"),
        unix_micros_ntz(F.col("ts")).alias("u_us"),
        F.timestamp_micros(F.unix_micros(instant)).cast("timestamp_ntz").alias("from_us"),
        _day(F.date_from_unix_date(F.unix_date(F.to_date("ts")))).alias("from_day"),
        F.timestamp_seconds(F.unix_seconds(instant)).cast("timestamp_ntz").alias("from_sec"),
    )


@query(
    "dt_construct",
    """
    SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') AS month_start,
           make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), o_orderkey % 24, o_orderkey % 60, 7.25) AS built,
           CAST(o_orderdate AS DATE) + INTERVAL 1 HOUR AS from_date,
           strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M:%S.%f') AS time_of_day
    FROM orders
    """,
)
def dt_construct(spark, sf_dir):
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day(F.make_date(F.year(d), F.month(d), F.lit(1))).alias("month_start"),
        F.make_timestamp_ntz(
            F.year(d), F.month(d), F.dayofmonth(d), (key % 24).cast("int"), (key % 60).cast("int"), F.lit(7.25)
        ).alias("built"),
        (F.to_date(d).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")).alias("from_date"),
        time_text(d + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 86400).cast("decimal(18,6)"))).alias("time_of_day"),
    )


EXTRACT_PARTS = ["year", "quarter", "month", "week", "day", "doy", "hour", "minute"]


@query(
    "dt_extract",
    "SELECT event_id, "
    + ", ".join(f"CAST(extract({p} FROM ts) AS INTEGER) AS e_{p}" for p in EXTRACT_PARTS)
    + ", CAST(extract(dow FROM ts) + 1 AS INTEGER) AS e_dayofweek, CAST(isoyear(ts) AS INTEGER) AS e_isoyear, "
    "CAST(epoch_us(ts) % 60000000 / 1000000.0 AS DECIMAL(8,6)) AS e_seconds, strftime(ts, '%Y-%m-%d') AS e_date, strftime(ts, '%H:%M:%S.%f') AS e_time FROM events",
)
def dt_extract(spark, sf_dir):
    parts = [F.expr(f"CAST(extract({p} FROM ts) AS INT)").alias(f"e_{p}") for p in EXTRACT_PARTS]
    return table(spark, sf_dir, "events").select(
        "event_id",
        *parts,
        F.dayofweek("ts").alias("e_dayofweek"),
        F.expr("CAST(extract(YEAROFWEEK FROM ts) AS INT)").alias("e_isoyear"),
        F.expr("CAST(extract(SECOND FROM ts) AS DECIMAL(8,6))").alias("e_seconds"),
        _day("ts").alias("e_date"),
        time_text(F.col("ts")).alias("e_time"),
    )


@query(
    "dt_format_parse",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS as_text, o_orderdate AS parsed, strftime(o_orderdate, '%Y%j') AS year_day,
           strftime(o_orderdate, '%A %B') AS names
    FROM orders
    """,
)
def dt_format_parse(spark, sf_dir):
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.alias("as_text"),
        F.to_timestamp_ntz(text, F.lit("dd/MM/yyyy")).alias("parsed"),
        F.date_format("o_orderdate", "yyyyDDD").alias("year_day"),
        F.date_format("o_orderdate", "EEEE MMMM").alias("names"),
    )


@query(
    "dt_last_day",
    "SELECT strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, count(*) AS n FROM orders GROUP BY month_end",
)
def dt_last_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(_day(F.last_day("o_orderdate")).alias("month_end")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "interval_ops",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate + to_days(l_linenumber) + to_hours(CAST(l_quantity AS INTEGER)) AS shifted,
           CAST(CAST(l_quantity AS BIGINT) // 24 AS BIGINT) AS j_days, CAST(CAST(l_quantity AS BIGINT) % 24 AS BIGINT) AS j_hours,
           CAST(l_partkey // 30 AS BIGINT) AS j_months, CAST(l_partkey % 30 AS BIGINT) AS j_rest_days,
           CAST(sign(w) * (abs(w) // 720) AS BIGINT) AS ji_months, CAST(sign(w) * (abs(w) // 24 % 30) AS BIGINT) AS ji_days, CAST(sign(w) * (abs(w) % 24) AS BIGINT) AS ji_hours,
           strftime(l_shipdate + to_months(14), '%Y-%m-%d') AS plus_14_months
    FROM (SELECT *, (l_linenumber * 30 - l_partkey) * 24 + CAST(l_quantity AS BIGINT) * 7 AS w FROM lineitem)
    """,
)
def interval_ops(spark, sf_dir):
    hours = F.col("l_quantity").cast("bigint")
    span = F.make_dt_interval(F.col("l_linenumber"), F.col("l_quantity").cast("int"))
    days, rest_hours = justify_hours(hours)
    months, rest_days = justify_days(F.col("l_partkey"))
    # Mixed signs: some months, many days back, some hours on.
    all_months, all_days, all_hours = justify_interval(F.col("l_linenumber").cast("bigint"), -F.col("l_partkey"), hours * 7)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_shipdate") + span).alias("shifted"),
        days.alias("j_days"), rest_hours.alias("j_hours"), months.alias("j_months"), rest_days.alias("j_rest_days"),
        all_months.alias("ji_months"), all_days.alias("ji_days"), all_hours.alias("ji_hours"),
        _day(F.col("l_shipdate") + F.make_ym_interval(F.lit(1), F.lit(2))).alias("plus_14_months"),
    )


@query(
    "date_arith",
    """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 7, '%Y-%m-%d') AS plus_int,
           CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS minus_date,
           o_orderdate + INTERVAL 36 HOUR AS plus_interval, o_orderdate - INTERVAL 36 HOUR * 2 AS minus_twice,
           o_orderdate + INTERVAL 18 HOUR AS plus_half
    FROM orders
    """,
)
def date_arith(spark, sf_dir):
    day, ts = F.to_date("o_orderdate"), F.col("o_orderdate")
    step = F.expr("INTERVAL 36 HOUR")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day(F.date_add(day, 7)).alias("plus_int"),
        F.date_diff(F.lit("2002-01-01").cast("date"), day).alias("minus_date"),
        (ts + step).alias("plus_interval"),
        (ts - step * 2).alias("minus_twice"),
        (ts + step / 2).alias("plus_half"),
    )


@query(
    "dt_bucket",
    "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, event_type, count(*) AS n, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM events GROUP BY ALL",
)
def dt_bucket(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.window("ts", "6 hours")["start"].alias("bucket"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    )


def hourly_spine(events):
    """Every hour from the first to the last event: one row with two bounds, expanded."""
    bounds = events.agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("h")).select(
        F.col("h").cast("timestamp_ntz").alias("hour")
    )


@query(
    "dt_series",
    """
    WITH errors AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
         span AS (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events)
    SELECT CAST(s.hour AS TIMESTAMP) AS hour, coalesce(n, 0) AS n_errors
    FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM span) s LEFT JOIN errors USING (hour)
    """,
)
def dt_series(spark, sf_dir):
    """Error counts per hour with the silent hours filled in."""
    events = table(spark, sf_dir, "events")
    errors = (
        events.filter("event_type = 'error'")
        .groupBy(trunc_to("hour", F.col("ts")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return hourly_spine(events).join(errors, "hour", "left").select(
        "hour", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_errors")
    )


@query(
    "dt_date_series",
    """
    WITH days AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
         span AS (SELECT min(d) AS a, max(d) AS b FROM days)
    SELECT strftime(s.d, '%Y-%m-%d') AS day, coalesce(n, 0) AS n_orders
    FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span) s LEFT JOIN days ON days.d = s.d
    """,
)
def dt_date_series(spark, sf_dir):
    """A calendar of days from the first to the last order, with the orders of each."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    span = days.agg(F.min("d").alias("a"), F.max("d").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    return calendar.join(days, "d", "left").select(_day(F.col("d")).alias("day"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n_orders"))


@query(
    "dt_time",
    """
    WITH t AS (SELECT o_orderkey, o_orderkey % 24 AS h, (o_orderkey * 7) % 60 AS m, (o_orderkey * 13) % 60 AS s FROM orders),
         c AS (SELECT *, make_time(h, m, s::DOUBLE) AS clock FROM t)
    SELECT o_orderkey, strftime(DATE '2024-01-01' + clock, '%H:%M:%S') AS time_text, strftime(DATE '2024-01-01' + clock, '%H:00:00') AS hour_start,
           CAST(h * 60 + m - 60 AS BIGINT) + CASE WHEN h * 60 + m - 60 < 0 AND s > 0 THEN 1 ELSE 0 END AS minutes_since_one,
           strftime(DATE '2024-01-01' + clock + INTERVAL 0 SECOND, '%H:%M:%S') AS parsed, true AS clock_in_day,
           strftime(DATE '2024-01-02' + clock + INTERVAL 5000 SECOND, '%H:%M:%S') AS later, strftime(DATE '2024-01-02' + clock - INTERVAL 600 MINUTE, '%H:%M:%S') AS earlier,
           strftime(DATE '2024-01-01' + clock, '%I:%M %p, %S') AS styled
    FROM c
    """,
)
def dt_time(spark, sf_dir):
    """Times of day: built, truncated, compared, written and read back; the current time is one as well."""
    key = F.col("o_orderkey")
    times = table(spark, sf_dir, "orders").select(
        key, F.expr("make_time(cast(o_orderkey % 24 AS INT), cast(o_orderkey * 7 % 60 AS INT), cast(o_orderkey * 13 % 60 AS DECIMAL(8, 6)))").alias("t")
    )
    return times.select(
        "o_orderkey",
        F.col("t").cast("string").alias("time_text"),
        F.expr("cast(time_trunc('HOUR', t) AS STRING)").alias("hour_start"),
        F.expr("time_diff('MINUTE', to_time('01.00', 'HH.mm'), t)").alias("minutes_since_one"),
        F.expr("cast(to_time(cast(t AS STRING)) AS STRING)").alias("parsed"),
        F.expr("current_time() BETWEEN to_time('00:00:00') AND to_time('23:59:59.999999')").alias("clock_in_day"),
        time_add(F.col("t"), F.lit(5000), "second").cast("string").alias("later"),
        time_add(F.col("t"), F.lit(-600), "minute").cast("string").alias("earlier"),
        format_time("hh:mm a, ss", F.col("t")).alias("styled"),
    )
