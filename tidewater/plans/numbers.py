"""Arithmetic, bitwise and math queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import (
    extremum,
    ieee_divide,
    int32_to_uint32,
    int64_to_uint64,
    is_inf,
    range_bucket,
    safe_add,
    safe_multiply,
    safe_negate,
    safe_subtract,
    shift_left,
    shift_right,
    trunc_digits,
    uint32_to_int32,
    uint64_to_int64,
)
from tidewater.plans.registry import query
from tidewater.session import table

KEY = ["l_orderkey", "l_partkey", "l_linenumber"]


def _money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "arith",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_orderkey + l_partkey AS a_plus, l_orderkey - l_partkey AS a_minus,
           l_linenumber * l_partkey AS a_times, l_quantity / 4 AS a_over, -l_partkey AS a_neg,
           CAST(trunc((l_partkey - 700)::DOUBLE / 7) AS BIGINT) AS a_div, (l_partkey - 700) % 7 AS a_mod,
           CAST(18446744073709551615::DECIMAL(20,0) - l_orderkey AS DECIMAL(21,0)) AS u_minus,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(23,4)) AS n_times,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) % 7 AS DECIMAL(18,2)) AS n_mod
    FROM lineitem
    """,
)
def arith(spark, sf_dir):
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        (key + part).alias("a_plus"),
        (key - part).alias("a_minus"),
        (F.col("l_linenumber") * part).alias("a_times"),
        (F.col("l_quantity") / 4).alias("a_over"),
        (-part).alias("a_neg"),
        F.expr("(l_partkey - 700) div 7").alias("a_div"),
        ((part - 700) % 7).alias("a_mod"),
        (F.lit("18446744073709551615").cast("decimal(20,0)") - key.cast("decimal(20,0)")).cast("decimal(21,0)").alias("u_minus"),
        (_money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(23,4)").alias("n_times"),
        (_money("l_extendedprice") % F.lit(7).cast("decimal(18,2)")).cast("decimal(18,2)").alias("n_mod"),
    )


@query(
    "arith_safe",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           TRY_CAST(9223372036854775000::HUGEINT + l_partkey AS BIGINT) AS s_add,
           TRY_CAST(-9223372036854775000::HUGEINT - l_partkey AS BIGINT) AS s_sub,
           TRY_CAST(l_partkey::HUGEINT * 9000000000000000 AS BIGINT) AS s_mul,
           CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS s_div,
           TRY_CAST(-(CASE WHEN l_linenumber = 1 THEN -9223372036854775808 ELSE l_partkey END)::HUGEINT AS BIGINT) AS s_neg
    FROM lineitem
    """,
)
def arith_safe(spark, sf_dir):
    part = F.col("l_partkey")
    lowest = F.when(F.col("l_linenumber") == 1, F.expr("-9223372036854775808L")).otherwise(part)
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        safe_add(F.lit(9223372036854775000), part).alias("s_add"),
        safe_subtract(F.lit(-9223372036854775000), part).alias("s_sub"),
        safe_multiply(part, F.lit(9000000000000000)).alias("s_mul"),
        F.round(F.try_divide("l_tax", "l_discount"), 6).alias("s_div"),
        safe_negate(lowest).alias("s_neg"),
    )


@query(
    "ieee_divide",
    """
    SELECT l_discount = 0 AS by_zero, count(*) FILTER (WHERE l_discount = 0 AND l_quantity <> 25) AS n_inf,
           count(*) FILTER (WHERE l_discount = 0 AND l_quantity > 25) AS n_plus_inf,
           count(*) FILTER (WHERE l_discount = 0 AND l_quantity = 25) AS n_nan,
           CAST(sum(CAST(round((l_quantity - 25) / nullif(l_discount, 0), 4) AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS finite_sum
    FROM lineitem GROUP BY by_zero
    """,
)
def ieee_divide_query(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_discount") == 0).alias("by_zero"), ieee_divide(F.col("l_quantity") - 25, F.col("l_discount")).alias("r")
    )
    r = F.col("r")
    finite = ~(is_inf(r) | F.isnan(r))
    return rows.groupBy("by_zero").agg(
        F.count_if(is_inf(r)).alias("n_inf"),
        F.count_if(r == float("inf")).alias("n_plus_inf"),
        F.count_if(F.isnan(r)).alias("n_nan"),
        F.sum(F.when(finite, F.round(r, 4)).cast("decimal(18,4)")).cast("decimal(28,4)").alias("finite_sum"),
    )


@query(
    "bitwise",
    """
    SELECT *, bit_count(w)::INTEGER AS n_bits FROM (
    SELECT l_orderkey, l_partkey, l_linenumber, ~l_partkey AS w, l_partkey & l_orderkey AS b_and, l_partkey | l_orderkey AS b_or,
           xor(l_partkey, l_orderkey) AS b_xor,
           CASE WHEN l_linenumber * 10 >= 64 THEN 0 ELSE CAST(((l_partkey::HUGEINT * (2::HUGEINT ** (l_linenumber * 10))::HUGEINT + 9223372036854775808) % 18446744073709551616) - 9223372036854775808 AS BIGINT) END AS b_left,
           CASE WHEN l_linenumber * 10 >= 64 THEN 0 ELSE CAST(floor_div AS BIGINT) END AS b_right
    FROM (SELECT *, (18446744073709551616::HUGEINT - l_partkey - 1) // (2::HUGEINT ** (l_linenumber * 10))::HUGEINT AS floor_div FROM lineitem))
    """,
)
def bitwise(spark, sf_dir):
    part, key, by = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber") * 10
    flipped = F.bitwise_not(part)
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        flipped.alias("w"),
        part.bitwiseAND(key).alias("b_and"),
        part.bitwiseOR(key).alias("b_or"),
        part.bitwiseXOR(key).alias("b_xor"),
        shift_left(part, by).alias("b_left"),
        shift_right(flipped, by).alias("b_right"),
        F.bit_count(flipped).alias("n_bits"),
    )


@query(
    "sign_round",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, abs(x) AS x_abs, CAST(sign(x) AS INTEGER) AS x_sign,
           CAST(round(x, 1) AS DECIMAL(19,1)) AS x_round, CAST(round_even(x, 1) AS DECIMAL(19,1)) AS x_even,
           CAST(ceil(x) AS DECIMAL(18,0)) AS x_ceil, CAST(floor(x) AS DECIMAL(18,0)) AS x_floor,
           CAST(sign(x) * floor(abs(x) * 10) AS BIGINT) AS x_trunc_tenths
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) - 50000 AS x FROM (SELECT * FROM lineitem))
    """.replace("- 50000 AS x", "- CAST(50000 AS DECIMAL(17,2)) AS x"),
)
def sign_round(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "x", (_money("l_extendedprice") - F.lit(50000).cast("decimal(17,2)")).cast("decimal(19,2)")
    )
    x = F.col("x")
    return lines.select(
        *KEY,
        F.abs(x).alias("x_abs"),
        F.signum(x).cast("int").alias("x_sign"),
        F.round(x, 1).cast("decimal(19,1)").alias("x_round"),
        F.bround(x, 1).cast("decimal(19,1)").alias("x_even"),
        F.ceil(x).cast("decimal(18,0)").alias("x_ceil"),
        F.floor(x).cast("decimal(18,0)").alias("x_floor"),
        (trunc_digits(x, 1) * 10).cast("bigint").alias("x_trunc_tenths"),
    )


@query(
    "pow_log",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, round(sqrt(l_quantity), 6) AS f_sqrt, round(cbrt(l_quantity), 6) AS f_cbrt,
           round(pow(l_quantity, 1.5), 4) AS f_pow, round(exp(l_tax), 6) AS f_exp, round(ln(l_extendedprice), 6) AS f_ln,
           round(log(l_extendedprice) , 6) AS f_log10, round(ln(l_extendedprice) / ln(3), 6) AS f_log3
    FROM lineitem
    """,
)
def pow_log(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        F.round(F.sqrt(q), 6).alias("f_sqrt"),
        F.round(F.cbrt(q), 6).alias("f_cbrt"),
        F.round(F.pow(q, F.lit(1.5)), 4).alias("f_pow"),
        F.round(F.exp("l_tax"), 6).alias("f_exp"),
        F.round(F.ln(p), 6).alias("f_ln"),
        F.round(F.log10(p), 6).alias("f_log10"),
        F.round(F.log(3.0, p), 6).alias("f_log3"),
    )


PLAIN_TRIG = ["cos", "cosh", "acos", "sin", "sinh", "asin", "asinh", "tan", "tanh", "atan", "atanh"]


@query(
    "trig",
    "SELECT vec_id, "
    + ", ".join(f"round({f}(x), 6) AS f_{f}" for f in PLAIN_TRIG)
    + """, round(acosh(y), 6) AS f_acosh, round(atan2(x, y), 6) AS f_atan2, round(1 / sin(y), 6) AS f_csc,
    round(1 / cos(x), 6) AS f_sec, round(cos(y) / sin(y), 6) AS f_cot, round(1 / sinh(y), 6) AS f_csch,
    round(1 / cosh(x), 6) AS f_sech, round(1 / tanh(y), 6) AS f_coth
    FROM (SELECT vec_id, embedding[1]::DOUBLE AS x, 1.5 + embedding[1]::DOUBLE AS y FROM embeddings)""",
)
def trig(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("x"), (F.col("embedding")[0].cast("double") + 1.5).alias("y")
    )
    x, y = F.col("x"), F.col("y")
    made = {f: getattr(F, f)(x) for f in PLAIN_TRIG} | {
        "acosh": F.acosh(y),
        "atan2": F.atan2(x, y),
        "csc": F.csc(y),
        "sec": F.sec(x),
        "cot": F.cot(y),
        "csch": 1 / F.sinh(y),
        "sech": 1 / F.cosh(x),
        "coth": 1 / F.tanh(y),
    }
    return rows.select("vec_id", *[F.round(c, 6).alias(f"f_{n}") for n, c in made.items()])


@query(
    "extrema",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, greatest(l_orderkey, l_partkey, l_suppkey) AS g, least(l_orderkey, l_partkey, l_suppkey) AS l,
           CASE WHEN l_tax > 0 THEN greatest(l_tax, l_discount) END AS g_null, CASE WHEN l_tax > 0 THEN least(l_tax, l_discount) END AS l_null
    FROM lineitem
    """,
)
def extrema(spark, sf_dir):
    keys = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    taxed = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        extremum(F.greatest, *keys).alias("g"),
        extremum(F.least, *keys).alias("l"),
        extremum(F.greatest, taxed, F.col("l_discount")).alias("g_null"),
        extremum(F.least, taxed, F.col("l_discount")).alias("l_null"),
    )


PRICE_BOUNDS = [10000.0, 30000.0, 60000.0, 90000.0]


@query(
    "range_bucket",
    "SELECT CAST("
    + " + ".join(f"(l_extendedprice >= {b})::INTEGER" for b in PRICE_BOUNDS)
    + " AS INTEGER) AS bucket, CAST(least(greatest(floor(l_extendedprice / 20000) + 1, 0), 11) AS BIGINT) AS even_bucket, count(*) AS n "
    "FROM lineitem GROUP BY ALL",
)
def range_bucket_query(spark, sf_dir):
    """Values below the first bound are in bucket 0, values from the last bound on in the last one."""
    return table(spark, sf_dir, "lineitem").groupBy(
        range_bucket(F.col("l_extendedprice"), PRICE_BOUNDS).alias("bucket"),
        F.width_bucket("l_extendedprice", F.lit(0.0), F.lit(200000.0), F.lit(10).cast("bigint")).alias("even_bucket"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "parse_number",
    r"""
    SELECT doc_id, TRY_CAST(s AS DECIMAL(38,9)) AS as_numeric, TRY_CAST(s AS DECIMAL(38,18)) AS as_big
    FROM (SELECT doc_id, regexp_extract(text, '([0-9]+([.][0-9]+)?)', 1) AS s FROM documents)
    """,
)
def parse_number(spark, sf_dir):
    """The first number in each document, NULL where there is none."""
    first = F.regexp_extract("text", r"([0-9]+([.][0-9]+)?)", 1)
    return table(spark, sf_dir, "documents").select(
        "doc_id", first.try_cast("decimal(38,9)").alias("as_numeric"), first.try_cast("decimal(38,18)").alias("as_big")
    )


@query(
    "random_ids",
    "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS in_range, true AS spread, true AS ids_well_formed FROM orders",
)
def random_ids(spark, sf_dir):
    """What must hold of random numbers and ids, whatever they are: in [0, 1), spread evenly, distinct."""
    drawn = table(spark, sf_dir, "orders").select(F.rand(7).alias("r"), F.uuid().alias("id"))
    return drawn.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.bool_and((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_range"),
        (F.abs(F.avg("r") - 0.5) < 6 * F.sqrt(F.lit(1.0) / (12 * F.count(F.lit(1))))).alias("spread"),
        F.bool_and(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("ids_well_formed"),
    )


@query(
    "bit_cast",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CAST(4294967296 - l_partkey - 1 AS BIGINT) AS u32, CAST(-l_partkey - 1 AS INTEGER) AS i32,
           CAST(18446744073709551616::HUGEINT - l_orderkey - 1 AS DECIMAL(20,0)) AS u64, CAST(-l_orderkey - 1 AS BIGINT) AS i64
    FROM lineitem
    """,
)
def bit_cast(spark, sf_dir):
    """Negative values to their unsigned twins and back."""
    i32, i64 = (-F.col("l_partkey") - 1).cast("int"), -F.col("l_orderkey") - 1
    rows = table(spark, sf_dir, "lineitem").select(*KEY, int32_to_uint32(i32).alias("u32"), int64_to_uint64(i64).alias("u64"))
    return rows.select(
        *KEY, "u32", uint32_to_int32(F.col("u32")).alias("i32"), "u64", uint64_to_int64(F.col("u64")).alias("i64")
    )
