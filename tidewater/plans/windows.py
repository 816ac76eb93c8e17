"""Window, ordering and union queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.frames import micros, moving_distinct, moving_extremes, sliding_distinct, sliding_extremes
from tidewater.operators.relational import exact_percentiles, rank_at_most, sort_by
from tidewater.operators.skew import null_safe_join
from tidewater.operators.windows import moving_sum, navigate, ranks, sliding_totals
from tidewater.plans.registry import query
from tidewater.session import materialise, table


def _money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "win_rank",
    """
    SELECT o_custkey, o_orderkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS row_number,
           rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
           round(percent_rank() OVER w, 9) AS percent_rank, round(cume_dist() OVER w, 9) AS cume_dist,
           CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS INTEGER) AS ntile
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)
    """,
)
def win_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    ranked = ranks(orders, ["o_custkey"], "o_orderpriority", "o_orderkey", tiles=4)
    return ranked.withColumns(
        {"percent_rank": F.round("percent_rank", 9), "cume_dist": F.round("cume_dist", 9)}
    )


@query(
    "win_nav",
    """
    SELECT user_id, event_id, lag(v) OVER w AS lag_value, lead(v) OVER w AS lead_value,
           first_value(v) OVER f AS first_value, last_value(v) OVER f AS last_value, nth_value(v, 2) OVER f AS nth_value,
           last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_known
    FROM (SELECT user_id, event_id, ts, nullif(event_type, 'view') AS v FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
           f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def win_nav(spark, sf_dir):
    """Neighbouring event types of each user, with 'view' as a missing value."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", F.nullif("event_type", F.lit("view")).alias("v")
    )
    return navigate(events, ["user_id"], ["ts", "event_id"], "v", nth=2).drop("ts", "v")


@query(
    "win_percentile",
    """
    SELECT event_id, event_type, value - quantile_cont(value, 0.5) OVER (PARTITION BY event_type) > 0 AS above_median,
           round(quantile_cont(value, 0.25) OVER (PARTITION BY event_type), 6) AS p25,
           quantile_disc(value, 0.25) OVER (PARTITION BY event_type) AS p25_disc
    FROM events
    """,
)
def win_percentile(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    # Written first, so that its real size decides the join and not a guess.
    per_type = materialise(exact_percentiles(events, ["event_type"], "value", {"p25": 0.25, "median": 0.5}), "per-type")
    return null_safe_join(events, per_type, ["event_type"]).select(
        "event_id",
        "event_type",
        (F.col("value") > F.col("median")).alias("above_median"),
        F.round("p25", 6).alias("p25"),
        "p25_disc",
    )


@query(
    "win_agg_frame",
    """
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS sum_last_3,
           count(*) OVER d AS n_day, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER d AS DECIMAL(28,2)) AS sum_day
    FROM events WINDOW d AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
    """,
)
def win_agg_frame(spark, sf_dir):
    """A row frame of three events and a range frame of one day, per user."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", _money("value").alias("v"))
    last3 = moving_sum(events, ["user_id"], ["ts", "event_id"], F.col("v"), 3, "sum_last_3")
    day = sliding_totals(
        events, ["user_id"], "ts", "1 DAY", {"n_day": F.lit(1).cast("bigint"), "sum_day": F.col("v")}
    )
    return null_safe_join(last3, day, ["user_id", "ts"]).select(
        "event_id", "user_id", F.col("sum_last_3").cast("decimal(28,2)").alias("sum_last_3"),
        F.col("n_day"), F.col("sum_day").cast("decimal(28,2)").alias("sum_day"),
    )


@query(
    "win_extreme_frame",
    """
    SELECT event_id, user_id, min(value) OVER r AS lowest_5, max(value) OVER r AS highest_5,
           min(value) OVER l AS lowest_100, max(value) OVER l AS highest_100,
           min(value) OVER d AS lowest_day, max(value) OVER d AS highest_day
    FROM events
    WINDOW r AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           l AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW),
           d AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
    """,
)
def win_extreme_frame(spark, sf_dir):
    """Extremes over five rows of a user, and over a hundred rows and a day of an event type."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value", micros(F.col("ts")).alias("at"))
    value = F.col("value")
    few = moving_extremes(events, ["user_id"], ["ts", "event_id"], value, 5, "lowest_5", "highest_5")
    many = moving_extremes(few, ["event_type"], ["ts", "event_id"], value, 100, "lowest_100", "highest_100")
    day = sliding_extremes(events, ["event_type"], "at", 86_400_000_000, value, "lowest_day", "highest_day")
    return null_safe_join(many, day, ["event_type", "at"]).drop("event_type", "ts", "value", "at")


@query(
    "win_distinct_frame",
    """
    SELECT event_id, count(DISTINCT kind) OVER r AS kinds_5, count(DISTINCT user_id) OVER d AS users_day
    FROM (SELECT *, nullif(event_type, 'view') AS kind FROM events)
    WINDOW r AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           d AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
    """,
)
def win_distinct_frame(spark, sf_dir):
    """Distinct event types in five rows of a user (views count as missing), distinct users of a type in a day."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", micros(F.col("ts")).alias("at"))
    kind = F.nullif("event_type", F.lit("view"))
    rows = moving_distinct(events, ["user_id"], ["ts", "event_id"], kind, 5, "kinds_5")
    day = sliding_distinct(events, ["event_type"], "at", 86_400_000_000, F.col("user_id"), "users_day")
    return null_safe_join(rows, day, ["event_type", "at"]).select("event_id", "kinds_5", "users_day")


@query(
    "sort",
    "SELECT o_orderkey, o_orderstatus AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders "
    "ORDER BY status, priority DESC NULLS LAST, o_orderkey",
)
def sort(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    return sort_by(rows, ("status", "asc"), ("priority", "desc"), ("o_orderkey", "asc"))


@query("limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 50")
def offset(spark, sf_dir):
    page = table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").offset(50).limit(25)
    return page.select("o_orderkey", "o_totalprice")


@query(
    "topk",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100",
)
def topk(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
        .limit(100)
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


@query(
    "topk_per_group",
    "SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn "
    "FROM orders QUALIFY rn <= 3",
)
def topk_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rank_at_most(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("union_streams", "SELECT * FROM orders")
def union_streams(spark, sf_dir):
    """Result streams of one result set put together again, by column name."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    filled, opened = orders.filter(status == "F"), orders.filter(status == "O")
    rest = orders.filter(~status.isin("F", "O") | status.isNull())
    return filled.unionByName(opened.select(*reversed(orders.columns))).unionByName(rest)
