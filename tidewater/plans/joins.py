"""Join queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import fixed, sum_fixed
from tidewater.operators.inequality import count_matches
from tidewater.operators.relational import band_join, left_join_hot
from tidewater.plans.registry import query
from tidewater.session import table, table_path
from tidewater.sources.sinks import export_files


def _ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@query(
    "join_inner",
    """
    SELECT c_custkey, c_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS spent
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name
    """,
)
def join_inner(spark, sf_dir):
    """Orders are summed per customer before the join, so a busy customer is one row in it."""
    spent = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), sum_fixed(fixed(F.col("o_totalprice"))).alias("spent"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customer.join(spent, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


@query(
    "join_left",
    """
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01')
    ON c_custkey = o_custkey
    """,
)
def join_left(spark, sf_dir):
    """Every customer, with urgent recent orders where there are any."""
    urgent = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= _ntz("2000-01-01"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    wanted = urgent.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return left_join_hot(customer, wanted, ["c_custkey"])


@query(
    "join_full",
    """
    SELECT coalesce(a.o_custkey, b.o_custkey) AS custkey, a.n AS n_early, b.n AS n_late FROM
      (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY o_custkey) a
    FULL JOIN
      (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey) b
    ON a.o_custkey = b.o_custkey
    """,
)
def join_full(spark, sf_dir):
    """Customers of the first and of the last year; both sides hold one row per key."""
    orders = table(spark, sf_dir, "orders")
    per = lambda df, name: df.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias(name))
    early = per(orders.filter(F.col("o_orderdate") < _ntz("1996-01-01")), "n_early")
    late = per(orders.filter(F.col("o_orderdate") >= _ntz("2001-01-01")), "n_late")
    return early.join(late, "custkey", "full")


@query(
    "join_theta",
    """
    SELECT c_custkey, p_partkey, p_retailprice FROM customer JOIN part
    ON p_retailprice >= c_acctbal - 0.5 AND p_retailprice < c_acctbal + 0.5
    """,
)
def join_theta(spark, sf_dir):
    """Parts priced within half a unit of a customer's balance, with no key in common."""
    bands = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") - 0.5).alias("low"), (F.col("c_acctbal") + 0.5).alias("high")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return band_join(parts, bands, "p_retailprice", "low", "high", width=1.0).select(
        "c_custkey", "p_partkey", "p_retailprice"
    )


@query(
    "join_two_sided",
    """
    SELECT a.p_partkey, count(b.p_partkey) AS n_dearer_smaller FROM part a
    LEFT JOIN part b ON a.p_retailprice < b.p_retailprice AND a.p_size > b.p_size GROUP BY a.p_partkey
    """,
)
def join_two_sided(spark, sf_dir):
    """For each part, how many parts are dearer and yet smaller."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    price, size = ("p_retailprice", "<", "p_retailprice"), ("p_size", ">", "p_size")
    return count_matches(part, part, price, size, "n_dearer_smaller").select("p_partkey", "n_dearer_smaller")


@query(
    "join_tree",
    """
    SELECT r_name, n_name, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(32,4)) AS revenue
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey
    GROUP BY r_name, n_name
    """,
)
def join_tree(spark, sf_dir):
    """Six tables; inputs of the tree are queries themselves.

    Orders learn their nation first, so the line items are shuffled once for the
    join and then shrink to one row per (supplier, nation) before suppliers join
    on that same key.
    """
    t = lambda name: table(spark, sf_dir, name)
    net = fixed(F.col("l_extendedprice")) * (F.lit(100) - fixed(F.col("l_discount")))
    lines = t("lineitem").select("l_orderkey", "l_suppkey", net.alias("net"))
    placed = (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    per_supplier = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"), sum_fixed(F.col("net"), 4, "decimal(32,4)").alias("s"))
    )
    local = per_supplier.join(
        t("supplier").select("s_suppkey", "s_nationkey"),
        (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")),
    )
    per_nation = local.groupBy("c_nationkey").agg(
        F.sum("n").alias("n_lines"), F.sum("s").cast("decimal(32,4)").alias("revenue")
    )
    return (
        per_nation.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "n_lines", "revenue")
    )


@query(
    "join_self_alias",
    """
    SELECT a.o_orderkey AS order_key, b.o_orderkey AS next_key, a.o_orderstatus AS status, b.o_orderstatus AS next_status
    FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 AND a.o_custkey <> b.o_custkey
    """,
)
def join_self_alias(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    a, b = orders.alias("a"), orders.alias("b")
    return a.join(
        b,
        (F.col("b.o_orderkey") == F.col("a.o_orderkey") + 1) & (F.col("a.o_custkey") != F.col("b.o_custkey")),
    ).select(
        F.col("a.o_orderkey").alias("order_key"),
        F.col("b.o_orderkey").alias("next_key"),
        F.col("a.o_orderstatus").alias("status"),
        F.col("b.o_orderstatus").alias("next_status"),
    )


@query(
    "join_federated",
    """
    SELECT c_mktsegment, s_nationkey, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) ON s_nationkey = c_nationkey
    WHERE n >= 2 GROUP BY c_mktsegment, s_nationkey
    """,
)
def join_federated(spark, sf_dir):
    """Sources of two kinds in one query: parquet tables and a JSON export."""
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    suppliers = export_files(table(spark, sf_dir, "supplier"), "json")
    nations = suppliers.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("k")).filter("k >= 2")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("s_nationkey"))
        .groupBy("c_mktsegment", "s_nationkey")
        .agg(F.sum("n").alias("n_orders"))
    )


@query(
    "join_filtered_agg",
    """
    SELECT l_orderkey, o_orderdate,
           CAST(sum(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2)))) AS DECIMAL(32,4)) AS revenue,
           count(*) AS n_lines
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderdate < timestamp '1997-01-01'
      AND l_shipdate > timestamp '1995-01-01'
    GROUP BY l_orderkey, o_orderdate HAVING sum(l_quantity) > 50
    ORDER BY revenue DESC, l_orderkey LIMIT 10
    """,
)
def join_filtered_agg(spark, sf_dir):
    """Join, filter, group, having, order and limit in one job.

    Line items are summed per order before they meet the orders, so the wide
    shuffle carries one row per order and the group key is the join key.
    """
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") < _ntz("1997-01-01"))
        .select("o_orderkey", "o_custkey", "o_orderdate")
    )
    net = fixed(F.col("l_extendedprice")) * (F.lit(100) - fixed(F.col("l_discount")))
    lines = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") > _ntz("1995-01-01"))
        .groupBy("l_orderkey")
        .agg(
            sum_fixed(net, 4, "decimal(32,4)").alias("revenue"),
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        .filter(F.col("quantity") > 50)
    )
    wanted = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return (
        lines.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "o_orderdate", "revenue", "n_lines")
        .orderBy(F.desc("revenue"), F.asc("l_orderkey"))
        .limit(10)
    )
