"""Projection, filter and predicate queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.registry import query
from tidewater.session import table


@query(
    "project_compute",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,4)) AS net_price,
           upper(l_returnflag) || '/' || lower(l_linestatus) AS flags
    FROM lineitem
    """,
)
def project_compute(spark, sf_dir):
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        net.cast("decimal(24,4)").alias("net_price"),
        F.concat_ws("/", F.upper("l_returnflag"), F.lower("l_linestatus")).alias("flags"),
    )


@query("project_none", "SELECT count(*) AS n_rows FROM orders")
def project_none(spark, sf_dir):
    """No columns at all: only the number of rows is left."""
    return table(spark, sf_dir, "orders").select().agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "field_ref_alias",
    "SELECT c.c_name AS name, o.o_orderkey AS order_key FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey "
    "WHERE c.c_acctbal < 0 AND o.o_orderstatus = 'F'",
)
def field_ref_alias(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer").alias("c"), table(spark, sf_dir, "orders").alias("o")
    return (
        c.join(o, F.col("c.c_custkey") == F.col("o.o_custkey"))
        .filter((F.col("c.c_acctbal") < 0) & (F.col("o.o_orderstatus") == "F"))
        .select(F.col("c.c_name").alias("name"), F.col("o.o_orderkey").alias("order_key"))
    )


@query(
    "literals",
    """
    SELECT c_custkey, true AS a_bool, CAST(7 AS INTEGER) AS an_int32, CAST(-9000000000 AS BIGINT) AS an_int64,
           CAST(18446744073709551615 AS DECIMAL(20,0)) AS a_uint64, CAST(1.5 AS FLOAT) AS a_float,
           CAST(-2.25 AS DOUBLE) AS a_double, CAST(56.012345679 AS DECIMAL(38,9)) AS a_numeric, 'text' AS a_string,
           hex(encode('bytes')) AS some_bytes, '2024-02-29' AS a_date, TIMESTAMP '2024-02-29 12:34:56.789' AS a_datetime,
           '20:30:40.000543' AS a_time, '{"k": [1, 2]}' AS a_json, CAST(NULL AS BIGINT) AS a_null
    FROM customer
    """,
)
def literals(spark, sf_dir):
    """A constant of each type beside every row."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lit(True).alias("a_bool"),
        F.lit(7).cast("int").alias("an_int32"),
        F.lit(-9000000000).cast("bigint").alias("an_int64"),
        F.lit("18446744073709551615").cast("decimal(20,0)").alias("a_uint64"),
        F.lit(1.5).cast("float").alias("a_float"),
        F.lit(-2.25).alias("a_double"),
        F.lit("56.0123456789").cast("decimal(38,9)").alias("a_numeric"),
        F.lit("text").alias("a_string"),
        F.hex(F.lit(b"bytes")).alias("some_bytes"),
        F.lit("2024-02-29").cast("date").cast("string").alias("a_date"),
        F.lit("2024-02-29 12:34:56.789").cast("timestamp_ntz").alias("a_datetime"),
        F.lit("20:30:40.000543").alias("a_time"),
        F.lit('{"k": [1, 2]}').alias("a_json"),
        F.lit(None).cast("bigint").alias("a_null"),
    )


@query(
    "filter",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-09-02' "
    "AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24 GROUP BY l_returnflag",
)
def filter_query(spark, sf_dir):
    kept = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_shipdate") < F.lit("1998-09-02").cast("timestamp_ntz"))
        & F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24)
    )
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


CMP = [("eq", "="), ("ne", "<>"), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")]


@query(
    "cmp",
    "SELECT l_linenumber, "
    + ", ".join(f"count(*) FILTER (WHERE l_quantity {op} 25) AS n_{n}" for n, op in CMP)
    + " FROM lineitem GROUP BY l_linenumber",
)
def cmp(spark, sf_dir):
    counts = [F.expr(f"count_if(l_quantity {op} 25)").alias(f"n_{n}") for n, op in CMP]
    return table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(*counts)


MIXED = """
SELECT {signed} AS s, {unsigned} AS u FROM lineitem
"""
MIXED_OUT = """
  count(*) FILTER (WHERE s = u) AS n_equal, count(*) FILTER (WHERE s < u) AS n_less,
  count(*) FILTER (WHERE s > u) AS n_greater, count(*) FILTER (WHERE s BETWEEN 0 AND u) AS n_between,
  count(*) FILTER (WHERE s IS DISTINCT FROM u) AS n_distinct
"""


@query(
    "cmp_mixed_sign",
    f"""
    SELECT l_returnflag, {MIXED_OUT} FROM (
      SELECT l_returnflag, CAST(CASE WHEN l_discount > 0.05 THEN -l_orderkey ELSE l_partkey END AS DECIMAL(20,0)) AS s,
             CAST(CASE WHEN l_tax > 0.06 THEN 18446744073709551615 - l_orderkey ELSE l_partkey END AS DECIMAL(20,0)) AS u
      FROM lineitem) GROUP BY l_returnflag
    """,
)
def cmp_mixed_sign(spark, sf_dir):
    """Signed and unsigned 64-bit values compared by value: both widen to 20 digits."""
    top = F.lit("18446744073709551615").cast("decimal(20,0)")
    wide = lambda name: F.col(name).cast("decimal(20,0)")
    pairs = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_discount") > 0.05, -F.col("l_orderkey")).otherwise(F.col("l_partkey")).cast("decimal(20,0)").alias("s"),
        F.when(F.col("l_tax") > 0.06, (top - wide("l_orderkey")).cast("decimal(20,0)")).otherwise(wide("l_partkey")).alias("u"),
    )
    s, u = F.col("s"), F.col("u")
    return pairs.groupBy("l_returnflag").agg(
        F.count_if(s == u).alias("n_equal"),
        F.count_if(s < u).alias("n_less"),
        F.count_if(s > u).alias("n_greater"),
        F.count_if(s.between(F.lit(0), u)).alias("n_between"),
        F.count_if(~s.eqNullSafe(u)).alias("n_distinct"),
    )


@query(
    "bool_logic",
    """
    SELECT a, b, a AND b AS both, a OR b AS either, NOT a AS not_a, a IS TRUE AS a_true, a IS FALSE AS a_false, count(*) AS n
    FROM (SELECT nullif(quality, 1) = 0 AS a, toxic = 1 AS b FROM documents LEFT JOIN labels USING (doc_id))
    GROUP BY a, b
    """,
)
def bool_logic(spark, sf_dir):
    """Three-valued logic: documents without a label make NULLs."""
    flags = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(F.expr("nullif(quality, 1) = 0").alias("a"), (F.col("toxic") == 1).alias("b"))
    )
    a, b = F.col("a"), F.col("b")
    return (
        flags.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "a", "b", (a & b).alias("both"), (a | b).alias("either"), (~a).alias("not_a"),
            F.expr("a IS TRUE").alias("a_true"), F.expr("a IS FALSE").alias("a_false"), "n",
        )
    )


@query(
    "null_safe_cmp",
    """
    SELECT event_type, count(*) FILTER (WHERE v IS NULL) AS n_null,
           count(*) FILTER (WHERE v IS DISTINCT FROM w) AS n_distinct,
           count(*) FILTER (WHERE v IS NOT DISTINCT FROM w) AS n_same
    FROM (SELECT event_type, CASE WHEN value >= 5 THEN value END AS v, CASE WHEN value < 20 THEN value END AS w FROM events)
    GROUP BY event_type
    """,
)
def null_safe_cmp(spark, sf_dir):
    v, w = F.when(F.col("value") >= 5, F.col("value")), F.when(F.col("value") < 20, F.col("value"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.count_if(v.isNull()).alias("n_null"),
            F.count_if(~v.eqNullSafe(w)).alias("n_distinct"),
            F.count_if(v.eqNullSafe(w)).alias("n_same"),
        )
    )


@query(
    "in_between",
    """
    SELECT o_orderstatus,
           count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_in,
           count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS n_not_in,
           count(*) FILTER (WHERE list_contains(['3-MEDIUM', '5-LOW'], o_orderpriority)) AS n_in_array,
           count(*) FILTER (WHERE o_totalprice BETWEEN 100000 AND 200000) AS n_between
    FROM orders GROUP BY o_orderstatus
    """,
)
def in_between(spark, sf_dir):
    p = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(
            F.count_if(p.isin("1-URGENT", "2-HIGH")).alias("n_in"),
            F.count_if(~p.isin("1-URGENT", "2-HIGH")).alias("n_not_in"),
            F.count_if(F.array_contains(F.array(F.lit("3-MEDIUM"), F.lit("5-LOW")), p)).alias("n_in_array"),
            F.count_if(F.col("o_totalprice").between(100000, 200000)).alias("n_between"),
        )
    )


@query(
    "like_any_all",
    """
    SELECT p_type, count(*) FILTER (WHERE p_name LIKE '%ring') AS n_like,
           count(*) FILTER (WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt%') AS n_any,
           count(*) FILTER (WHERE p_name LIKE '%e%' AND p_name LIKE '%t') AS n_all,
           count(*) FILTER (WHERE p_brand LIKE '%1' OR p_brand LIKE '%2_') AS n_any_array,
           count(*) FILTER (WHERE p_brand LIKE 'Brand%' AND p_brand LIKE '%#1%') AS n_all_array,
           count(*) FILTER (WHERE p_name LIKE '%ring') AS n_like_bytes
    FROM part GROUP BY p_type
    """,
)
def like_any_all(spark, sf_dir):
    any_of, all_of = ["%1", "%2_"], ["Brand%", "%#1%"]
    arr = lambda ps: F.array(*[F.lit(p) for p in ps])
    brand = F.col("p_brand")
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_type")
        .agg(
            F.expr("count_if(p_name LIKE '%ring')").alias("n_like"),
            F.expr("count_if(p_name LIKE ANY ('red%', '%bolt%'))").alias("n_any"),
            F.expr("count_if(p_name LIKE ALL ('%e%', '%t'))").alias("n_all"),
            F.count_if(F.exists(arr(any_of), lambda p: F.like(brand, p))).alias("n_any_array"),
            F.count_if(F.forall(arr(all_of), lambda p: F.like(brand, p))).alias("n_all_array"),
            F.count_if(F.like(F.decode(F.encode("p_name", "UTF-8"), "UTF-8"), F.lit("%ring"))).alias("n_like_bytes"),
        )
    )


@query(
    "case_when",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'large' END AS size,
           CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status,
           CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END AS is_rushed
    FROM orders
    """,
)
def case_when(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price < 100000, "small").when(price < 300000, "middle").otherwise("large").alias("size"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END").alias("status"),
        F.expr("if(o_orderpriority < '3', 1, 0)").alias("is_rushed"),
    )


@query(
    "null_funcs",
    """
    SELECT event_id, coalesce(CASE WHEN value > 50 THEN value END, CASE WHEN value < 10 THEN -value END, 0.0) AS first_known,
           ifnull(nullif(event_type, 'error'), 'none') AS kind, nullif(event_type, 'click') AS not_click
    FROM events
    """,
)
def null_funcs(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(F.when(v > 50, v), F.when(v < 10, -v), F.lit(0.0)).alias("first_known"),
        F.ifnull(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"),
        F.nullif("event_type", F.lit("click")).alias("not_click"),
    )


@query(
    "error_funcs",
    """
    SELECT event_type,
           CAST(sum(coalesce(TRY_CAST(regexp_extract(props, '([a-z0-9]+)}?$', 1) AS BIGINT), -1)) AS BIGINT) AS parsed_or_minus_one,
           count(TRY_CAST(regexp_extract(props, '([a-z0-9]+)}?$', 1) AS BIGINT)) AS n_null_if_error,
           count(*) FILTER (WHERE TRY_CAST(event_type AS BIGINT) IS NULL AND event_type IS NOT NULL) AS n_is_error,
           count(*) FILTER (WHERE user_id % 4 = 0) AS n_divide_errors, count(*) AS n_checked
    FROM events GROUP BY event_type
    """,
)
def error_funcs(spark, sf_dir):
    """IFERROR, NULLIFERROR, ISERROR and ERROR through the try_ family."""
    tail = F.regexp_extract("props", r"([a-z0-9]+)}?$", 1)
    parsed = tail.try_cast("bigint")
    kind = F.col("event_type")
    ratio = F.try_divide(F.lit(1), F.col("user_id") % 4)
    checked = F.when(F.col("event_id") < 0, F.raise_error(F.lit("negative id")).cast("bigint")).otherwise(F.col("event_id"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.sum(F.coalesce(parsed, F.lit(-1))).alias("parsed_or_minus_one"),
            F.count(parsed).alias("n_null_if_error"),
            F.count_if(kind.try_cast("bigint").isNull() & kind.isNotNull()).alias("n_is_error"),
            F.count_if(ratio.isNull()).alias("n_divide_errors"),
            F.count(checked).alias("n_checked"),
        )
    )


@query(
    "typeof",
    "SELECT 'bigint' AS t_key, 'int' AS t_line, 'double' AS t_qty, 'string' AS t_flag, 'timestamp_ntz' AS t_ship, "
    "'decimal(18,2)' AS t_money, count(*) AS n FROM lineitem",
)
def typeof(spark, sf_dir):
    typed = table(spark, sf_dir, "lineitem").select(
        F.typeof("l_orderkey").alias("t_key"),
        F.typeof("l_linenumber").alias("t_line"),
        F.typeof("l_quantity").alias("t_qty"),
        F.typeof("l_returnflag").alias("t_flag"),
        F.typeof("l_shipdate").alias("t_ship"),
        F.typeof(F.col("l_extendedprice").cast("decimal(18,2)")).alias("t_money"),
    )
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("n"))
