"""Aggregation and sketch queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import fixed, sum_fixed, sum_interval
from tidewater.operators.aggregates import daily_changes, fold_changes, merge_rollup, partial_rollup, signed_distinct, top_sum
from tidewater.operators.relational import exact_percentiles, group_implicit
from tidewater.plans.registry import query
from tidewater.session import materialise, table


def _money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "agg_global",
    "SELECT count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, "
    "max(l_quantity) AS max_qty FROM lineitem WHERE l_quantity < 0 "
    "UNION ALL SELECT count(*), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)), max(l_quantity) FROM lineitem",
)
def agg_global(spark, sf_dir):
    """One row with no keys, over an empty input too."""
    lines = table(spark, sf_dir, "lineitem")
    totals = lambda df: df.agg(
        F.count(F.lit(1)).alias("n"),
        sum_fixed(fixed(F.col("l_extendedprice"))).alias("total"),
        F.max("l_quantity").alias("max_qty"),
    )
    return totals(lines.filter("l_quantity < 0")).unionByName(totals(lines))


@query(
    "agg_group",
    """
    SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year, count(*) AS n,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sum_price,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(32,4)) AS sum_net,
           CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_discount
    FROM lineitem GROUP BY ALL
    """.replace("year(l_shipdate)", "CAST(year(l_shipdate) AS INTEGER)"),
)
def agg_group(spark, sf_dir):
    price, discount = fixed(F.col("l_extendedprice")), fixed(F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            sum_fixed(fixed(F.col("l_quantity"))).alias("sum_qty"),
            sum_fixed(price).alias("sum_price"),
            sum_fixed(price * (F.lit(100) - discount), 4, "decimal(32,4)").alias("sum_net"),
            (sum_fixed(discount).cast("double") / F.count(F.lit(1))).alias("avg_discount"),
        )
    )


@query(
    "agg_implicit_keys",
    "SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders, "
    "max(o_totalprice) AS largest FROM orders GROUP BY ALL",
)
def agg_implicit_keys(spark, sf_dir):
    return group_implicit(
        table(spark, sf_dir, "orders"),
        plain={"status": F.col("o_orderstatus"), "order_year": F.year("o_orderdate")},
        aggregates={"n_orders": F.count(F.lit(1)), "largest": F.max("o_totalprice")},
    )


@query(
    "having",
    "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey "
    "HAVING count(*) > 12 AND max(o_totalprice) > 300000",
)
def having(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("largest"))
        .filter("n_orders > 12 AND largest > 300000")
        .drop("largest")
    )


@query(
    "distinct",
    "SELECT event_type, count(DISTINCT user_id) AS n_users FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY event_type",
)
def distinct(spark, sf_dir):
    """Distinct pairs, then a count of them: two combining steps, neither bound to one hot key."""
    pairs = table(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    return pairs.groupBy("event_type").agg(F.count("user_id").alias("n_users"))


@query(
    "agg_count",
    "SELECT event_type, count(*) AS n, count(CASE WHEN value > 10 THEN value END) AS n_known, "
    "count(*) FILTER (WHERE value > 50) AS n_large FROM events GROUP BY event_type",
)
def agg_count(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("value") > 10, F.col("value"))).alias("n_known"),
            F.count_if(F.col("value") > 50).alias("n_large"),
        )
    )


@query(
    "agg_sum_avg",
    """
    SELECT l_returnflag, CAST(sum(l_orderkey) AS BIGINT) AS sum_int, sum(l_orderkey)::DOUBLE / count(*) AS avg_int,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(38,9))) AS DECIMAL(38,9)) AS sum_numeric,
           CAST(sum(18446744073709551615::DECIMAL(20,0) - l_orderkey) AS DECIMAL(30,0)) AS sum_uint,
           sum(CAST(l_tax AS DECIMAL(18,2)))::DOUBLE / count(*) AS avg_double,
           CAST(sum(date_diff('day', o_orderdate, l_shipdate)) AS BIGINT) AS sum_lag_days,
           CAST(sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) // count(*) // 1000000 AS BIGINT) AS avg_lag_seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag
    """,
)
def agg_sum_avg(spark, sf_dir):
    """Sums and averages over integer, unsigned, decimal, double and interval inputs."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    top = F.lit("18446744073709551615").cast("decimal(20,0)")
    lag = F.col("l_shipdate") - F.col("o_orderdate")
    sums = lines.groupBy("l_returnflag").agg(
        F.sum("l_orderkey").alias("sum_int"),
        (F.sum("l_orderkey").cast("double") / F.count(F.lit(1))).alias("avg_int"),
        F.sum(F.col("l_extendedprice").cast("decimal(28,9)")).cast("decimal(38,9)").alias("sum_numeric"),
        F.sum((top - F.col("l_orderkey").cast("decimal(20,0)")).cast("decimal(20,0)")).cast("decimal(30,0)").alias("sum_uint"),
        (F.sum(_money("l_tax")).cast("double") / F.count(F.lit(1))).alias("avg_double"),
        sum_interval(lag).alias("lag"),
        F.count(lag).alias("n_lags"),
    )
    # Whole days and whole seconds are what is compared.
    days = F.col("lag") / F.lit(86_400)
    mean_seconds = F.floor(F.col("lag") / F.col("n_lags")).cast("bigint")
    lags = {"sum_lag_days": days.cast("bigint"), "avg_lag_seconds": mean_seconds}
    return sums.withColumns(lags).drop("lag", "n_lags")


@query(
    "agg_min_max_any",
    "SELECT o_custkey, min(o_totalprice) AS lowest, max(o_orderdate) AS latest, o_custkey AS any_key FROM orders GROUP BY o_custkey",
)
def agg_min_max_any(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_totalprice").alias("lowest"),
            F.max("o_orderdate").alias("latest"),
            F.any_value("o_custkey").alias("any_key"),
        )
    )


@query(
    "agg_string",
    """
    SELECT l_orderkey, string_agg(l_returnflag, '|' ORDER BY l_returnflag) AS flags,
           string_agg(DISTINCT l_linestatus, '' ORDER BY l_linestatus) AS statuses,
           string_agg(CASE WHEN l_quantity > 25 THEN l_returnflag END, '' ORDER BY l_returnflag) AS large_flags
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_string(spark, sf_dir):
    """Whole-group strings per order: duplicates kept, duplicates removed, NULLs left out; bytes as well as text."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("large")
    )
    return lines.groupBy("l_orderkey").agg(
        F.expr("listagg(l_returnflag, '|') WITHIN GROUP (ORDER BY l_returnflag)").alias("flags"),
        F.expr("listagg(DISTINCT l_linestatus) WITHIN GROUP (ORDER BY l_linestatus)").alias("statuses"),
        F.expr("decode(listagg(encode(large, 'UTF-8')) WITHIN GROUP (ORDER BY encode(large, 'UTF-8')), 'UTF-8')").alias("large_flags"),
    )


@query(
    "agg_partial_lists",
    """
    SELECT l_orderkey, string_agg(l_returnflag, '|' ORDER BY l_partkey, l_linenumber, l_returnflag) AS flags,
           string_agg(coalesce(CAST(CASE WHEN l_quantity > 25 THEN l_linenumber END AS VARCHAR), 'null'), ','
                      ORDER BY l_partkey, l_linenumber, l_returnflag, l_quantity) AS large_lines,
           count(*) AS n
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_partial_lists(spark, sf_dir):
    """Ordered strings and arrays from stored partial states, one per order and status, merged per order."""
    lines = table(spark, sf_dir, "lineitem")
    large = F.when(F.col("l_quantity") > 25, F.col("l_linenumber"))
    parts = {
        "fs": ("list", F.struct("l_partkey", "l_linenumber", "l_returnflag")),
        "ls": ("list", F.struct("l_partkey", "l_linenumber", "l_returnflag", "l_quantity", large.alias("large"))),
        "n": ("count", F.lit(1)),
    }
    stored = materialise(partial_rollup(lines, ["l_orderkey", "l_linestatus"], parts), "lists")
    merged = merge_rollup(stored, ["l_orderkey"], parts)
    return merged.select(
        "l_orderkey",
        F.array_join(F.sort_array("fs")["l_returnflag"], "|").alias("flags"),
        F.array_join(F.transform(F.sort_array("ls")["large"], lambda x: x.cast("string")), ",", "null").alias("large_lines"),
        "n",
    )


@query(
    "agg_array",
    """
    SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles,
           string_agg(coalesce(CAST(CASE WHEN role = 'user' THEN length(text) END AS VARCHAR), 'null'), ',' ORDER BY turn) AS sizes,
           count(*) * 2 AS n_concat
    FROM conversations GROUP BY conv_id
    """,
)
def agg_array(spark, sf_dir):
    """Ordered arrays of whole conversations; NULLs stay in, because each element travels inside a struct."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", F.struct("turn", "role", F.when(F.col("role") == "user", F.length("text")).alias("size")).alias("t")
    )
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.array_agg("t")).alias("ts"),
        F.size(F.flatten(F.array_agg(F.array(F.col("t.role"), F.col("t.role"))))).cast("bigint").alias("n_concat"),
    )
    return whole.select(
        "conv_id",
        F.array_join("ts.role", ",").alias("roles"),
        F.array_join(F.transform("ts.size", lambda s: s.cast("string")), ",", "null").alias("sizes"),
        "n_concat",
    )


@query(
    "agg_bit",
    """
    SELECT l_returnflag, bit_and(l_partkey) AS and_key, bit_or(l_partkey) AS or_key, bit_xor(l_partkey) AS xor_key,
           bit_and(l_linenumber) AS and_line, bit_or(l_linenumber) AS or_line, bit_xor(l_linenumber) AS xor_line
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_bit(spark, sf_dir):
    made = []
    for name, column in (("key", "l_partkey"), ("line", "l_linenumber")):
        made += [
            F.bit_and(column).alias(f"and_{name}"),
            F.bit_or(column).alias(f"or_{name}"),
            F.bit_xor(column).alias(f"xor_{name}"),
        ]
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*made)


@query(
    "agg_logical",
    "SELECT quality, bool_and(toxic = 0) AS all_clean, bool_or(toxic = 1) AS any_toxic FROM labels GROUP BY quality",
)
def agg_logical(spark, sf_dir):
    return (
        table(spark, sf_dir, "labels")
        .groupBy("quality")
        .agg(F.bool_and(F.col("toxic") == 0).alias("all_clean"), F.bool_or(F.col("toxic") == 1).alias("any_toxic"))
    )


STATS = [
    ("corr", "corr(l_quantity, l_discount)"),
    ("covar_pop", "covar_pop(l_quantity, l_discount)"),
    ("covar_samp", "covar_samp(l_quantity, l_discount)"),
    ("stddev_pop", "stddev_pop(l_quantity)"),
    ("stddev_samp", "stddev_samp(l_quantity)"),
    ("var_pop", "var_pop(l_quantity)"),
    ("var_samp", "var_samp(l_quantity)"),
]


@query(
    "agg_stats",
    "SELECT l_returnflag, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in STATS) + " FROM lineitem GROUP BY l_returnflag",
)
def agg_stats(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        *[F.expr(f"round({e}, 6)").alias(n) for n, e in STATS]
    )


@query(
    "agg_percentile",
    """
    SELECT event_type, round(median(value), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90,
           quantile_disc(value, 0.5) AS median_disc, quantile_disc(value, 0.9) AS p90_disc
    FROM events GROUP BY event_type
    """,
)
def agg_percentile(spark, sf_dir):
    found = exact_percentiles(table(spark, sf_dir, "events"), ["event_type"], "value", {"median": 0.5, "p90": 0.9})
    return found.select(
        "event_type",
        F.round("median", 6).alias("median"),
        F.round("p90", 6).alias("p90"),
        "median_disc",
        "p90_disc",
    )


def _event_parts():
    value = F.col("value")
    return {
        "total": ("sum", value.cast("decimal(18,2)")),
        "n": ("count", F.lit(1)),
        "n_value": ("count", F.when(value > 10, value)),
        "n_large": ("count_if", value > 50),
        "largest": ("max", value),
        "smallest": ("min", value),
        "all_positive": ("logical_and", value > 0),
        "any_huge": ("logical_or", value > 90),
        "bits_and": ("bit_and", F.col("event_id")),
        "bits_or": ("bit_or", F.col("event_id")),
        "bits_xor": ("bit_xor", F.col("event_id")),
        "tens": ("set", F.floor(F.least(value, F.lit(99)) / 10)),
    }


@query(
    "agg_partial_final",
    """
    SELECT event_type, strftime(ts, '%Y-%m') AS month, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, count(*) AS n,
           count(CASE WHEN value > 10 THEN 1 END) AS n_value, count(*) FILTER (WHERE value > 50) AS n_large,
           max(value) AS largest, min(value) AS smallest, bool_and(value > 0) AS all_positive, bool_or(value > 90) AS any_huge,
           bit_and(event_id) AS bits_and, bit_or(event_id) AS bits_or, bit_xor(event_id) AS bits_xor,
           array_to_string(list_sort(list(DISTINCT CAST(floor(least(value, 99) / 10) AS BIGINT))), ',') AS tens
    FROM events GROUP BY event_type, month
    """,
)
def agg_partial_final(spark, sf_dir):
    """Daily partial states are stored, then merged by month; equals the direct answer."""
    parts = _event_parts()
    daily = materialise(
        partial_rollup(table(spark, sf_dir, "events"), ["event_type", F.to_date("ts").alias("day")], parts), "rollup"
    )
    months = merge_rollup(daily, ["event_type", F.date_format("day", "yyyy-MM").alias("month")], parts)
    return months.withColumn("total", F.col("total").cast("decimal(28,2)")).withColumn(
        "tens", F.array_join(F.transform(F.sort_array("tens"), lambda t: t.cast("string")), ",")
    )


@query(
    "agg_non_additive",
    """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
    FROM orders GROUP BY ALL
    """,
)
def agg_non_additive(spark, sf_dir):
    """A ratio is kept as numerator and denominator and derived only when read."""
    orders = table(spark, sf_dir, "orders")
    monthly = orders.groupBy("o_orderstatus", F.date_trunc("month", "o_orderdate").alias("month")).agg(
        sum_fixed(fixed(F.col("o_totalprice"))).alias("num"), F.count(F.lit(1)).alias("den")
    )
    return monthly.groupBy("o_orderstatus", F.year("month").alias("order_year")).agg(
        (F.sum("num").cast("double") / F.sum("den")).alias("avg_price")
    )


@query(
    "approx_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS n_exact, true AS within_bound FROM events GROUP BY event_type",
)
def approx_distinct(spark, sf_dir):
    """The estimate stays within three standard errors (5 % each) of the exact count."""
    events = table(spark, sf_dir, "events")
    approx = events.groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("estimate"))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_exact"))
    return approx.join(exact, "event_type").select(
        "event_type", "n_exact", (F.abs(F.col("estimate") - F.col("n_exact")) <= 0.15 * F.col("n_exact")).alias("within_bound")
    )


QUANTILES = 4
ACCURACY = 10_000


@query(
    "approx_quantiles",
    f"SELECT l_returnflag, count(*) AS n, CAST({QUANTILES + 1} AS INTEGER) AS n_boundaries, true AS within_bound FROM lineitem GROUP BY l_returnflag",
)
def approx_quantiles(spark, sf_dir):
    """n+1 boundaries per group; each must have a rank within 1/accuracy (plus ties) of its target."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    fractions = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    bounds = lines.groupBy("l_returnflag").agg(
        F.approx_percentile("l_extendedprice", fractions, ACCURACY).alias("b"), F.count(F.lit(1)).alias("n")
    )
    bounds = materialise(bounds, "bounds")  # its real size decides the join below
    slack = F.greatest(F.col("n") * (2.0 / ACCURACY), F.lit(2.0))
    checks, agg = [], []
    for i in range(QUANTILES + 1):
        value = F.col("b")[i]
        agg += [
            F.count_if(F.col("l_extendedprice") < value).alias(f"below_{i}"),
            F.count_if(F.col("l_extendedprice") <= value).alias(f"upto_{i}"),
        ]
        target = F.col("n") * (i / QUANTILES)
        checks.append((F.col(f"below_{i}") - slack <= target) & (target <= F.col(f"upto_{i}") + slack))
    within = checks[0]
    for c in checks[1:]:
        within = within & c
    ranked = lines.join(bounds, "l_returnflag").groupBy("l_returnflag", "n", F.size("b").alias("n_boundaries")).agg(*agg)
    return ranked.select("l_returnflag", "n", "n_boundaries", within.alias("within_bound"))


@query(
    "approx_top_count",
    """
    SELECT event_type AS item, count(*) AS n, 'one pass' AS how FROM events GROUP BY event_type
    QUALIFY row_number() OVER (ORDER BY count(*) DESC) <= 3
    UNION ALL
    SELECT event_type, count(*), 'merged' FROM events GROUP BY event_type
    QUALIFY row_number() OVER (ORDER BY count(*) DESC) <= 3
    """,
)
def approx_top_count(spark, sf_dir):
    """The three most frequent event types, from one pass and from merged daily sketches."""
    events = table(spark, sf_dir, "events")
    once = events.agg(F.expr("approx_top_k(event_type, 3)").alias("t")).select(F.inline("t")).withColumn("how", F.lit("one pass"))
    daily = materialise(
        events.groupBy(F.to_date("ts").alias("day")).agg(F.expr("approx_top_k_accumulate(event_type, 1000)").alias("s")),
        "topk",
    )
    merged = (
        daily.agg(F.expr("approx_top_k_combine(s, 1000)").alias("s"))
        .select(F.inline(F.expr("approx_top_k_estimate(s, 3)")))
        .withColumn("how", F.lit("merged"))
    )
    return once.unionByName(merged).select("item", F.col("count").alias("n"), "how")


@query(
    "approx_top_sum",
    "SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM lineitem "
    "GROUP BY l_partkey ORDER BY total DESC, l_partkey LIMIT 10",
)
def approx_top_sum(spark, sf_dir):
    return top_sum(table(spark, sf_dir, "lineitem"), "l_partkey", sum_fixed(fixed(F.col("l_extendedprice"))), 10)


@query(
    "hll_sketch",
    "SELECT event_type, count(DISTINCT user_id) AS n_exact, true AS within_bound, true AS merges_agree FROM events GROUP BY event_type",
)
def hll_sketch(spark, sf_dir):
    """Daily sketches are stored, merged, and merged again from monthly partial merges."""
    events = table(spark, sf_dir, "events")
    daily = materialise(
        events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.hll_sketch_agg("user_id").alias("s")), "hll"
    )
    straight = daily.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("a"))
    monthly = daily.groupBy("event_type", F.date_trunc("month", "day").alias("m")).agg(F.hll_union_agg("s").alias("s"))
    stepped = monthly.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("b"))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_exact"))
    return (
        exact.join(straight, "event_type")
        .join(stepped, "event_type")
        .select(
            "event_type",
            "n_exact",
            (F.abs(F.col("a") - F.col("n_exact")) <= 0.08 * F.col("n_exact") + 1).alias("within_bound"),
            (F.abs(F.col("a") - F.col("b")) <= 0.02 * F.col("a") + 1).alias("merges_agree"),
        )
    )


@query(
    "distinct_with_deletes",
    """
    SELECT event_type, count(*) AS n_distinct, true AS within_bound FROM (
      SELECT event_type, user_id FROM events GROUP BY event_type, user_id
      HAVING sum(CASE WHEN value < 5 THEN -1 ELSE 1 END) > 0) GROUP BY event_type
    """,
)
def distinct_with_deletes(spark, sf_dir):
    """Users added more often than deleted, exactly and as a difference of two sketches of the exact net set."""
    events = table(spark, sf_dir, "events")
    sign = F.when(F.col("value") < 5, -1).otherwise(1)
    exact = signed_distinct(events, ["event_type"], "user_id", sign)
    net = events.groupBy("event_type", "user_id").agg(F.sum(sign).alias("net"))
    sketches = net.groupBy("event_type").agg(
        F.expr("theta_sketch_agg(user_id)").alias("added"),
        F.expr("theta_sketch_agg(CASE WHEN net <= 0 THEN user_id END)").alias("deleted"),
    )
    left = sketches.select(
        "event_type", F.expr("theta_sketch_estimate(theta_difference(added, deleted))").alias("estimate")
    )
    return exact.join(left, "event_type").select(
        "event_type",
        "n_distinct",
        (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct") + 1).alias("within_bound"),
    )


@query(
    "distinct_change_states",
    """
    SELECT event_type, count(*) FILTER (in_set) AS n_distinct, true AS within_bound, true AS halves_agree
    FROM (SELECT event_type, user_id, arg_max(value >= 40, (ts, event_id)) AS in_set FROM events GROUP BY event_type, user_id)
    GROUP BY event_type
    """,
)
def distinct_change_states(spark, sf_dir):
    """Users of each event type: a high value puts one in, a low one takes it out, and it may come back.

    Two sketches per day are stored and folded in order of the days; the exact
    count stands beside the estimate. Folding the days of 2024's first half and
    of the rest apart, and then those two, must give the same.
    """
    events = table(spark, sf_dir, "events")
    adds, order = F.col("value") >= 40, [F.col("ts"), F.col("event_id")]
    daily = materialise(daily_changes(events, ["event_type"], F.to_date("ts"), "user_id", adds, order), "daily-changes")
    counted = lambda states, name: states.select(
        "event_type", F.expr("theta_sketch_estimate(added)").alias(name)
    )
    whole = counted(fold_changes(daily, ["event_type"]), "estimate")
    early = F.col("day") < F.lit("2024-01-15").cast("date")
    halves = fold_changes(daily.filter(early), ["event_type"]).withColumn("half", F.lit(1)).unionByName(
        fold_changes(daily.filter(~early), ["event_type"]).withColumn("half", F.lit(2))
    )
    again = counted(fold_changes(halves, ["event_type"], "half"), "again")
    last = events.groupBy("event_type", "user_id").agg(F.max_by(adds, F.struct(*order)).alias("in_set"))
    exact = last.groupBy("event_type").agg(F.count_if("in_set").alias("n_distinct"), F.count(F.lit(1)).alias("n_seen"))
    near = lambda c: F.abs(F.col(c) - F.col("n_distinct")) <= 0.1 * F.col("n_seen") + 1
    return exact.join(whole, "event_type").join(again, "event_type").select(
        "event_type",
        "n_distinct",
        near("estimate").alias("within_bound"),
        (near("again") & (F.abs(F.col("estimate") - F.col("again")) <= 0.02 * F.col("n_seen") + 1)).alias("halves_agree"),
    )


@query(
    "kll_sketch",
    "SELECT l_returnflag, count(*) AS n, true AS within_bound FROM lineitem GROUP BY l_returnflag",
)
def kll_sketch(spark, sf_dir):
    """Yearly quantile sketches are stored and merged; the median's true rank must be close to one half."""
    lines = table(spark, sf_dir, "lineitem")
    yearly = materialise(
        lines.groupBy("l_returnflag", F.year("l_shipdate").alias("y")).agg(
            F.expr("kll_sketch_agg_double(l_extendedprice)").alias("d"), F.expr("kll_sketch_agg_bigint(l_partkey)").alias("i")
        ),
        "kll",
    )
    merged = yearly.groupBy("l_returnflag").agg(
        F.expr("kll_merge_agg_double(d)").alias("d"), F.expr("kll_merge_agg_bigint(i)").alias("i")
    )
    points = merged.select(
        "l_returnflag",
        F.expr("kll_sketch_get_quantile_double(d, 0.5D)").alias("median_price"),
        F.expr("kll_sketch_get_quantile_bigint(i, 0.25D)").alias("quarter_part"),
    )
    ranks = lines.join(points, "l_returnflag").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_extendedprice") <= F.col("median_price")).alias("a"),
        F.count_if(F.col("l_partkey") <= F.col("quarter_part")).alias("b"),
    )
    near = lambda c, p: F.abs(F.col(c) / F.col("n") - p) <= 0.05
    return ranks.select("l_returnflag", "n", (near("a", 0.5) & near("b", 0.25)).alias("within_bound"))
