"""Typed conversion, schema conformance and cast queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.conform import (
    BIGNUMERIC,
    ISO,
    NUMERIC,
    conform,
    conform_checked,
    iso_text,
    reject_rows,
)
from tidewater.plans.registry import query
from tidewater.session import table


def as_text(df):
    """Every column as text, the way a file without types would deliver it."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


LINE_TYPES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice decimal(38,9), l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz"
)


@query(
    "conform_strict",
    "SELECT * REPLACE (CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS l_extendedprice) FROM lineitem",
)
def conform_strict(spark, sf_dir):
    """All-text line items cast to the declared types; one bad value would fail the job."""
    return conform(as_text(table(spark, sf_dir, "lineitem")), LINE_TYPES, formats={"l_shipdate": "yyyy-MM-dd HH:mm:ss"})


@query(
    "conform_fill",
    "SELECT CAST(NULL AS VARCHAR) AS country, event_id, user_id, CAST(value AS VARCHAR) AS value, event_type, "
    "CAST(NULL AS DECIMAL(38,9)) AS score, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE "
    "rtrim('.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END AS ts FROM events",
)
def conform_fill(spark, sf_dir):
    """Declared fields the source lacks become NULL; order and types follow the declaration."""
    declared = "country string, event_id bigint, user_id bigint, value string, event_type string, score decimal(38,9), ts string"
    return conform(table(spark, sf_dir, "events").drop("props"), declared, fill=True)


DAMAGED_SQL = """
SELECT event_id, 'value' AS "column", CAST(value AS VARCHAR) || 'x' AS raw FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'user_id', 'u' || user_id FROM events WHERE event_type = 'signup'
UNION ALL SELECT event_id, 'ts', 'not a time' FROM events WHERE value > 400
"""


def damaged_events(spark, sf_dir):
    """Events as text in which some types of events carry broken values."""
    kind = F.col("event_type")
    return as_text(table(spark, sf_dir, "events")).withColumns(
        {
            "ts": F.when(F.col("value").cast("double") > 400, F.lit("not a time")).otherwise(F.col("ts")),
            "value": F.when(kind == "error", F.concat("value", F.lit("x"))).otherwise(F.col("value")),
            "user_id": F.when(kind == "signup", F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id")),
        }
    )


EVENT_TYPES = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENT_FORMATS = {"ts": ISO}


@query("conform_quarantine", DAMAGED_SQL)
def conform_quarantine(spark, sf_dir):
    """The reject table: every bad value with its row's key, its column and its raw text."""
    checked = conform_checked(damaged_events(spark, sf_dir), EVENT_TYPES, EVENT_FORMATS)
    return reject_rows(checked, ["event_id"])


@query(
    "decimal_normalise",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS price,
           CAST(l_linenumber AS DECIMAL(38,9)) AS line, CAST(CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(38,18)) AS big_tax,
           CAST(round(CAST(l_partkey AS DECIMAL(38,12)) * 0.0000000005, 9) AS DECIMAL(38,9)) AS half_up
    FROM lineitem
    """,
)
def decimal_normalise(spark, sf_dir):
    """To 9 decimals (half away from zero) and to the widest decimal Spark holds."""
    tiny = F.col("l_partkey").cast("decimal(20,0)") * F.lit("0.0000000005").cast("decimal(10,10)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_extendedprice").cast(NUMERIC).alias("price"),
        F.col("l_linenumber").cast(NUMERIC).alias("line"),
        F.col("l_tax").cast(BIGNUMERIC).alias("big_tax"),
        tiny.cast(NUMERIC).alias("half_up"),
    )


@query(
    "time_normalise",
    """
    SELECT event_id, ts - INTERVAL 6 HOUR AS datetime_6, ts - INTERVAL 330 MINUTE AS datetime_530,
           CAST(epoch_us(ts) - 21600000000 AS BIGINT) AS instant_us
    FROM events
    """,
)
def time_normalise(spark, sf_dir):
    """Local times at +06:00 and +05:30 brought to UTC, as civil time and as instant."""
    local = F.col("ts").cast("timestamp")
    at6, at530 = F.to_utc_timestamp(local, "+06:00"), F.to_utc_timestamp(local, "+05:30")
    return table(spark, sf_dir, "events").select(
        "event_id",
        at6.cast("timestamp_ntz").alias("datetime_6"),
        at530.cast("timestamp_ntz").alias("datetime_530"),
        F.unix_micros(at6).alias("instant_us"),
    )


@query(
    "nested_build",
    """
    SELECT conv_id, CAST(to_json(list({'turn': turn, 'role': role, 'size': length(text)} ORDER BY turn)) AS VARCHAR) AS turns
    FROM conversations GROUP BY ALL
    """,
)
def nested_build(spark, sf_dir):
    """Flat turns to one array of structs per conversation."""
    turn = F.struct("turn", "role", F.length("text").alias("size"))
    whole = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.withColumn("turns", F.to_json("turns"))


@query(
    "cast_numeric",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_partkey AS INTEGER) AS i64_i32, CAST(l_linenumber AS BIGINT) AS i32_i64,
           CAST(l_linenumber AS DOUBLE) AS i32_f64, CAST(l_linenumber > 3 AS INTEGER) AS bool_i32, l_partkey % 2 <> 0 AS i64_bool,
           CAST(trunc(l_extendedprice) AS BIGINT) AS f64_i64, CAST(l_quantity AS FLOAT) AS f64_f32, CAST(l_orderkey AS DECIMAL(38,9)) AS i64_num,
           CAST(CAST(l_tax AS DECIMAL(38,9)) AS DECIMAL(38,18)) AS num_big, CAST(l_orderkey AS DECIMAL(20,0)) AS i64_u64,
           CAST(l_partkey AS BIGINT) AS i64_u32
    FROM lineitem
    """,
)
def cast_numeric(spark, sf_dir):
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        part.cast("int").alias("i64_i32"),
        line.cast("bigint").alias("i32_i64"),
        line.cast("double").alias("i32_f64"),
        (line > 3).cast("int").alias("bool_i32"),
        (part % 2).cast("boolean").alias("i64_bool"),
        F.col("l_extendedprice").cast("bigint").alias("f64_i64"),
        F.col("l_quantity").cast("float").alias("f64_f32"),
        F.col("l_orderkey").cast(NUMERIC).alias("i64_num"),
        F.col("l_tax").cast(NUMERIC).cast(BIGNUMERIC).alias("num_big"),
        F.col("l_orderkey").cast("decimal(20,0)").alias("i64_u64"),
        part.cast("bigint").alias("i64_u32"),
    )


@query(
    "cast_string",
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
           CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END AS bool_text, strftime(o_orderdate, '%Y-%m-%d') AS date_text,
           o_orderkey AS key_back, CAST(o_totalprice AS DECIMAL(18,2)) AS price_back, o_orderdate AS date_back,
           strftime(o_orderdate, '%d.%m.%y') AS formatted, CAST(o_orderkey AS DECIMAL(12,0)) AS number_back
    FROM orders
    """,
)
def cast_string(spark, sf_dir):
    """To text and back, plainly and through format patterns."""
    money = F.col("o_totalprice").cast("decimal(18,2)")
    day = F.date_format("o_orderdate", "dd.MM.yy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        money.cast("string").alias("price_text"),
        (F.col("o_totalprice") > 200000).cast("string").alias("bool_text"),
        F.to_date("o_orderdate").cast("string").alias("date_text"),
        F.col("o_orderkey").cast("string").cast("bigint").alias("key_back"),
        money.cast("string").cast("decimal(18,2)").alias("price_back"),
        F.to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").cast("timestamp_ntz").alias("date_back"),
        day.alias("formatted"),
        F.to_number(F.format_string("%012d", "o_orderkey"), F.lit("999999999999")).alias("number_back"),
    )


@query(
    "cast_temporal",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS ts_date, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date_ts, ts AS via_instant,
           strftime(ts, '%H:%M:%S.%f') AS ts_time, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE rtrim('.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END AS ts_iso
    FROM events
    """,
)
def cast_temporal(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        ts.cast("date").cast("string").alias("ts_date"),
        ts.cast("date").cast("timestamp_ntz").alias("date_ts"),
        ts.cast("timestamp").cast("timestamp_ntz").alias("via_instant"),
        F.date_format(ts, "HH:mm:ss.SSSSSS").alias("ts_time"),
        iso_text(ts).alias("ts_iso"),
    )


@query(
    "cast_nested",
    """
    SELECT conv_id, turn, '[' || turn || ', ' || length(text) || ']' AS as_strings, CAST(turn AS INTEGER) AS s_turn, CAST(length(text) AS VARCHAR) AS s_size,
           CAST(CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 END AS INTEGER) AS role_code, role AS role_back,
           CAST(turn AS DOUBLE) AS range_start, CAST(turn + 1 AS DOUBLE) AS range_end
    FROM conversations
    """,
)
def cast_nested(spark, sf_dir):
    """Arrays and structs element by element; an enum through its label table."""
    labels = spark.createDataFrame([(0, "system"), (1, "user"), (2, "assistant")], "code int, label string")
    turns = table(spark, sf_dir, "conversations")
    array = F.array(F.col("turn"), F.length("text").cast("bigint")).cast("array<string>")
    struct = F.struct(F.col("turn").alias("a"), F.length("text").alias("b")).cast("struct<a:int,b:string>")
    spans = F.struct(F.col("turn").alias("start"), (F.col("turn") + 1).alias("end")).cast("struct<start:double,end:double>")
    return (
        turns.join(F.broadcast(labels), turns["role"] == labels["label"], "left")
        .withColumns({"s": struct, "r": spans})
        .select(
            "conv_id",
            "turn",
            F.concat(F.lit("["), F.array_join(array, ", "), F.lit("]")).alias("as_strings"),
            F.col("s.a").alias("s_turn"),
            F.col("s.b").alias("s_size"),
            F.col("code").alias("role_code"),
            F.col("label").alias("role_back"),
            F.col("r.start").alias("range_start"),
            F.col("r.end").alias("range_end"),
        )
    )


@query(
    "cast_safe",
    """
    SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN value || 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS as_double,
           CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS as_int64, CASE WHEN event_id < 128 THEN CAST(event_id AS INTEGER) END AS as_small,
           CAST(NULL AS BOOLEAN) AS as_bool, CASE WHEN value > 400 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS as_date,
           CASE WHEN value < 100 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(4,2)) END AS as_decimal
    FROM events
    """,
)
def cast_safe(spark, sf_dir):
    """Casts that give NULL where the value does not fit."""
    events = damaged_events(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("bigint"))
    return events.select(
        "event_id",
        F.col("value").try_cast("double").alias("as_double"),
        F.col("user_id").try_cast("bigint").alias("as_int64"),
        F.col("event_id").try_cast("tinyint").cast("int").alias("as_small"),
        F.col("event_type").try_cast("boolean").alias("as_bool"),
        F.substring("ts", 1, 10).try_cast("date").cast("string").alias("as_date"),
        F.rtrim("value", F.lit("x")).cast("decimal(18,2)").try_cast("decimal(4,2)").alias("as_decimal"),
    )


@query(
    "cast_expr_legacy",
    """
    SELECT o_orderkey, hex(encode(o_orderstatus)) AS same_bytes, '{"k": 1}' AS same_json, o_orderstatus AS same_text,
           strftime(o_orderdate + INTERVAL 90 MINUTE, '%H:%M') AS after_interval
    FROM orders
    """,
)
def cast_expr_legacy(spark, sf_dir):
    """Identity casts of bytes, text, JSON and intervals."""
    span = F.expr("CAST(CAST(INTERVAL '90' MINUTE AS INTERVAL DAY TO SECOND) AS INTERVAL DAY TO SECOND)")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.hex(F.encode("o_orderstatus", "UTF-8").cast("binary")).alias("same_bytes"),
        F.lit('{"k": 1}').cast("string").alias("same_json"),
        F.col("o_orderstatus").cast("string").alias("same_text"),
        F.date_format(F.col("o_orderdate") + span, "HH:mm").alias("after_interval"),
    )
