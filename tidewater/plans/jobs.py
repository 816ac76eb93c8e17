"""Table jobs that put the scalar families to work on whole tables."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.conform import conform_checked, good_rows, reject_rows
from tidewater.functions.numeric import fixed, ieee_divide, is_inf, range_bucket, sum_fixed, trunc_digits
from tidewater.functions.temporal import boundary_diff, trunc_to
from tidewater.functions.text import initcap, split_literal
from tidewater.operators.windows import moving_sum
from tidewater.plans.conforming import EVENT_FORMATS, EVENT_TYPES, damaged_events
from tidewater.plans.registry import query
from tidewater.session import materialise, table


def _money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "job_line_pricing",
    """
    SELECT l_orderkey, o_orderpriority, CAST(sum(net) AS DECIMAL(28,4)) AS net, CAST(sum(net * tax) AS DECIMAL(38,6)) AS tax,
           count(*) FILTER (WHERE d = 0) AS n_no_discount, CAST(max(greatest(d, tax)) AS DECIMAL(4,2)) AS top_rate,
           sum(net)::DOUBLE / nullif(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 0) AS net_per_returned,
           CAST(sum(floor(CAST(l_extendedprice AS DECIMAL(18,2)) / 1000)) AS BIGINT) AS thousands
    FROM (SELECT *, CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS tax,
                 CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_orderpriority
    """,
)
def job_line_pricing(spark, sf_dir):
    """Net revenue, tax and safe ratios per order; lines are summed before the join."""
    price, d, tax = fixed(F.col("l_extendedprice")), fixed(F.col("l_discount")), fixed(F.col("l_tax"))
    net = price * (F.lit(100) - d)
    net_sum = sum_fixed(net, 4, "decimal(28,4)")
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            net_sum.alias("net"),
            sum_fixed(net * tax, 6, "decimal(38,6)").alias("tax"),
            F.count_if(is_inf(ieee_divide(F.lit(1), F.col("l_discount")))).alias("n_no_discount"),
            (F.max(F.greatest("l_discount", "l_tax"))).cast("decimal(4,2)").alias("top_rate"),
            F.try_divide(net_sum.cast("double"), returned).alias("net_per_returned"),
            F.sum(trunc_digits(price / 100_000).cast("bigint")).alias("thousands"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


BALANCE_BOUNDS = [0.0, 1.0, 2.0, 3.0, 3.5]


@query(
    "job_account_bands",
    """
    SELECT side, CAST(CASE WHEN bal > 0 THEN (ln(bal) / ln(10) >= 0)::INT + (log10(bal) >= 1)::INT + (log10(bal) >= 2)::INT + (log10(bal) >= 3)::INT + (log10(bal) >= 3.5)::INT END AS INTEGER) AS band,
           CASE WHEN bal < 0 THEN 'debt' WHEN bal < 5000 THEN 'normal' ELSE 'rich' END AS label, count(*) AS n,
           CAST(sum(CAST(coalesce(nullif(bal, 0), 0) AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM (SELECT 'customer' AS side, c_acctbal AS bal FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY ALL
    """,
)
def job_account_bands(spark, sf_dir):
    """Log-scaled balance bands of customers and suppliers."""
    part = lambda name, column: table(spark, sf_dir, name).select(F.lit(name).alias("side"), F.col(column).alias("bal"))
    both = part("customer", "c_acctbal").unionByName(part("supplier", "s_acctbal"))
    bal = F.col("bal")
    return both.groupBy(
        "side",
        F.when(bal > 0, range_bucket(F.log10(bal), BALANCE_BOUNDS)).alias("band"),
        F.when(bal < 0, "debt").when(bal < 5000, "normal").otherwise("rich").alias("label"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(F.nullif("bal", F.lit(0.0)), F.lit(0.0)).cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"),
    )


@query(
    "job_flag_pack",
    """
    SELECT l_orderkey, bit_or(mask) AS flags, CAST(bit_count(bit_or(mask)) AS INTEGER) AS n_flags, bit_xor(l_partkey) AS parity,
           count(*) FILTER (WHERE (mask & 1) = 1) AS n_returned
    FROM (SELECT *, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 4 END + CASE l_linestatus WHEN 'O' THEN 8 ELSE 16 END AS BIGINT) AS mask FROM lineitem)
    GROUP BY l_orderkey
    """,
)
def job_flag_pack(spark, sf_dir):
    """A bit set per order of the return and line flags its lines carry."""
    flag = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(4)
    status = F.when(F.col("l_linestatus") == "O", 8).otherwise(16)
    packed = table(spark, sf_dir, "lineitem").withColumn("mask", flag.bitwiseOR(status).cast("bigint"))
    return packed.groupBy("l_orderkey").agg(
        F.bit_or("mask").alias("flags"),
        F.bit_count(F.bit_or("mask")).alias("n_flags"),
        F.bit_xor("l_partkey").alias("parity"),
        F.count_if(F.col("mask").bitwiseAND(F.lit(1)) == 1).alias("n_returned"),
    )


@query(
    "job_vector_angles",
    """
    WITH parts AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    means AS (SELECT label, pos, sum(CAST(x AS DECIMAL(38,12)))::DOUBLE / count(*) AS m FROM parts GROUP BY label, pos),
    sums AS (SELECT vec_id, p.label, sum(x * x) AS xx, sum(m * m) AS mm, sum(x * m) AS xm FROM parts p JOIN means USING (label, pos) GROUP BY ALL)
    SELECT vec_id, label, round(sqrt(xx), 5) AS norm, round(xm / sqrt(xx * mm), 5) AS cosine,
           CAST(floor(degrees(acos(xm / sqrt(xx * mm))) / 15) AS BIGINT) AS angle_bucket
    FROM sums
    """,
)
def job_vector_angles(spark, sf_dir):
    """Norm, cosine to the mean vector of the label, and angle buckets of 15 degrees."""
    vectors = table(spark, sf_dir, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
    cells = parts.groupBy("label", "pos").agg(
        (F.sum(F.col("x").cast("double").cast("decimal(38,12)")).cast("double") / F.count(F.lit(1))).alias("m")
    )
    # As many entries per label as a vector has dimensions.
    means = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "m")))["m"].alias("mean"))
    means = materialise(means, "means")  # its real size decides the join below
    add = lambda acc, v: acc + v
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), add)
    sized = vectors.join(means, "label").select(
        "vec_id", "label", dot("embedding", "embedding").alias("xx"), dot("mean", "mean").alias("mm"),
        dot("embedding", "mean").alias("xm"),
    )
    cosine = F.col("xm") / F.sqrt(F.col("xx") * F.col("mm"))
    return sized.select(
        "vec_id",
        "label",
        F.round(F.sqrt("xx"), 5).alias("norm"),
        F.round(cosine, 5).alias("cosine"),
        F.floor(F.degrees(F.acos(cosine)) / 15).alias("angle_bucket"),
    )


@query(
    "job_fulfilment_times",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, strftime(o_orderdate, '%A') AS weekday, count(*) AS n_lines,
           CAST(sum(date_diff('day', o_orderdate, l_shipdate)) AS BIGINT) AS sum_days, CAST(min(date_diff('day', o_orderdate, l_shipdate)) AS BIGINT) AS min_days,
           CAST(max(date_diff('month', o_orderdate, l_shipdate)) AS BIGINT) AS max_months,
           count(*) FILTER (WHERE l_shipdate > last_day(o_orderdate)) AS n_next_month,
           count(*) FILTER (WHERE l_shipdate < o_orderdate + INTERVAL 30 DAY) AS n_within_30
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def job_fulfilment_times(spark, sf_dir):
    """Order-to-ship lags by order month and weekday."""
    placed, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    days = boundary_diff("day", shipped, placed)
    lags = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.year(placed).alias("y"), F.month(placed).alias("m"), F.dayofweek(placed).alias("d"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(days).alias("sum_days"),
            F.min(days).alias("min_days"),
            F.max(boundary_diff("month", shipped, placed)).alias("max_months"),
            F.count_if(shipped > F.last_day(placed)).alias("n_next_month"),
            F.count_if(shipped < placed + F.expr("INTERVAL 30 DAY")).alias("n_within_30"),
        )
    )
    # Grouped on numbers; text is made once per group. 2023-01-01 was a Sunday.
    weekday = F.date_format(F.make_date(F.lit(2023), F.lit(1), F.col("d")), "EEEE")
    return lags.withColumns({"month": F.format_string("%04d-%02d", "y", "m"), "weekday": weekday}).drop("y", "m", "d")


@query(
    "job_calendar_fill",
    """
    WITH counts AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL),
         span AS (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events),
         spine AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM span),
         grid AS (SELECT event_type, hour FROM spine, (SELECT DISTINCT event_type FROM events))
    SELECT event_type, CAST(hour AS TIMESTAMP) AS hour, coalesce(n, 0) AS n,
           CAST(sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS BIGINT) AS n_day
    FROM grid LEFT JOIN counts USING (event_type, hour)
    """,
)
def job_calendar_fill(spark, sf_dir):
    """Gap-filled hourly counts per event type with a sum over the last 24 hours."""
    events = table(spark, sf_dir, "events")
    counts = events.groupBy("event_type", trunc_to("hour", F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "hour-counts")
    # The span of all events is one row; days are dealt out before they become hours.
    span = counts.agg(F.min("hour").alias("a"), F.max("hour").alias("b")).first()
    lit = lambda t: F.lit(t).cast("timestamp_ntz")
    days = F.explode(F.sequence(F.date_trunc("day", lit(span["a"])), lit(span["b"]), F.expr("INTERVAL 1 DAY")))
    kinds = counts.select("event_type").distinct().select("event_type", days.alias("day"))
    hours = F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: (F.col("day") + F.make_dt_interval(hours=h)).cast("timestamp_ntz")))
    grid = kinds.select("event_type", hours.alias("hour")).filter(
        F.col("hour").between(lit(span["a"]), lit(span["b"]))
    )
    filled = materialise(
        grid.join(counts, ["event_type", "hour"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))), "grid"
    )
    return moving_sum(filled, ["event_type"], ["hour"], F.col("n"), 24, "n_day")


@query(
    "job_name_clean",
    """
    SELECT name, count(*) AS n, min(c_custkey) AS first_key, max(code) AS code FROM (
      SELECT c_custkey, lower(trim(replace(c_mktsegment, '_', ' '))) || ' ' || ltrim(regexp_extract(c_name, '#(.*)$', 1)[6:], '0') AS name,
             chr(CAST(64 + length(c_mktsegment) AS INTEGER)) || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS code
      FROM customer) GROUP BY name
    """,
)
def job_name_clean(spark, sf_dir):
    """Cleaned customer names and groups that differ only in case."""
    number = F.ltrim("tail", F.lit("0"))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.trim(F.replace("c_mktsegment", F.lit("_"), F.lit(" "))).alias("segment"),
        F.substr(F.regexp_extract("c_name", "#(.*)$", 1), F.lit(6)).alias("tail"),
        F.concat(F.chr(F.lit(64) + F.length("c_mktsegment")), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("code"),
    )
    mixed = F.when(F.col("c_custkey") % 2 == 0, initcap(F.col("segment"))).otherwise(F.col("segment"))
    named = rows.select("c_custkey", "code", F.collate(F.concat(mixed, F.lit(" "), number), "UTF8_LCASE").alias("name"))
    groups = named.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_key"), F.max("code").alias("code")
    )
    return groups.withColumn("name", F.lower(F.collate("name", "UTF8_BINARY")))


@query(
    "job_part_tokens",
    """
    SELECT token, count(*) AS n_parts, count(*) FILTER (WHERE p_brand LIKE '%#1%' OR p_brand LIKE '%#2%') AS n_low_brands,
           CAST(min(p_size) AS INTEGER) AS smallest
    FROM (SELECT *, unnest(string_split(lower(p_type) || ' ' || p_name, ' ')) AS token FROM part) GROUP BY token
    """,
)
def job_part_tokens(spark, sf_dir):
    """Tokens of part types and names with their counts."""
    words = split_literal(F.concat_ws(" ", F.lower("p_type"), "p_name"), " ")
    tokens = table(spark, sf_dir, "part").select("p_brand", "p_size", F.explode(words).alias("token"))
    return tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.expr("count_if(p_brand LIKE ANY ('%#1%', '%#2%'))").alias("n_low_brands"),
        F.min("p_size").alias("smallest"),
    )


PATTERNS = {
    "number": "[0-9]+",
    "caps_word": "[A-Z]{4,}",
    "mail": "[a-z0-9.]+@[a-z0-9.]+",
    "phone": "[0-9]{3}-[0-9]{4}",
    "tag": "<[a-z]+",
}


def _hits_sql(table_name, text, group):
    hits = ", ".join(f"CAST(sum(len(regexp_extract_all({text}, '{p}'))) AS BIGINT) AS n_{n}" for n, p in PATTERNS.items())
    return f"SELECT '{table_name}' AS origin, {group} AS grp, count(*) AS n_rows, {hits} FROM {table_name} GROUP BY ALL"


@query(
    "job_text_mine",
    _hits_sql("documents", "text", "lang || '/' || source")
    + " UNION ALL "
    + _hits_sql("pages", "html", "regexp_extract(url, '[.]([a-z]+)/', 1)"),
)
def job_text_mine(spark, sf_dir):
    """Pattern hits in whole texts, per language and source and per top-level domain."""

    def hits(name, text, group):
        found = [
            F.sum(F.size(F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)))).alias(f"n_{n}") for n, p in PATTERNS.items()
        ]
        rows = table(spark, sf_dir, name).groupBy(F.lit(name).alias("origin"), group.alias("grp"))
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), *found)

    documents = hits("documents", "text", F.concat_ws("/", "lang", "source"))
    pages = hits("pages", "html", F.regexp_extract("url", "[.]([a-z]+)/", 1))
    return documents.unionByName(pages)


@query(
    "job_dialogue_rollup",
    """
    SELECT conv_id, count(*) AS n_turns, min_by(role, turn) AS first_role, max_by(role, turn) AS last_role,
           md5(min_by(CASE WHEN role = 'assistant' THEN text END, CASE WHEN role = 'assistant' THEN turn END)) AS first_reply,
           count(*) FILTER (WHERE prev IS DISTINCT FROM role) AS n_runs, CAST(max(length(text)) AS INTEGER) AS longest
    FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) GROUP BY conv_id
    """,
)
def job_dialogue_rollup(spark, sf_dir):
    """First reply, first and last role, and runs of one role per conversation.

    Runs are counted a page of 100 turns at a time; a run that goes on across
    the border of two pages counts once.
    """
    turns = table(spark, sf_dir, "conversations").withColumn("page_no", F.expr("turn div 100"))
    reply = F.col("role") == "assistant"
    pages = turns.groupBy("conv_id", "page_no").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("turn", "role")))["role"].alias("rs"),
        F.min(F.when(reply, F.col("turn"))).alias("reply_turn"),
        F.md5(F.min_by(F.when(reply, F.col("text")), F.when(reply, F.col("turn")))).alias("reply"),
        F.max(F.length("text")).alias("longest"),
    )
    changes = F.filter("rs", lambda r, i: (i == 0) | ~r.eqNullSafe(F.get(F.col("rs"), i - 1)))
    ends = pages.select(
        "*", F.size(changes).alias("runs"), F.get("rs", F.lit(0)).alias("first"), F.element_at("rs", -1).alias("last")
    )
    # A hundredth of the rows.
    before = F.lag(F.struct("last")).over(Window.partitionBy("conv_id").orderBy("page_no"))
    joined = ends.withColumn("goes_on", F.coalesce(before["last"].eqNullSafe(F.col("first")) & before.isNotNull(), F.lit(False)))
    return joined.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.min_by("first", "page_no").alias("first_role"),
        F.max_by("last", "page_no").alias("last_role"),
        F.min_by("reply", "reply_turn").alias("first_reply"),
        F.sum(F.col("runs") - F.col("goes_on").cast("int")).alias("n_runs"),
        F.max("longest").alias("longest"),
    )


@query(
    "job_props_shred",
    """
    SELECT event_type, count(*) AS n, count(k) AS n_typed, CAST(sum(k) AS BIGINT) AS sum_k, count(*) FILTER (WHERE k IS NULL) AS n_bad
    FROM (SELECT event_type, CASE WHEN value >= 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events) GROUP BY event_type
    """,
)
def job_props_shred(spark, sf_dir):
    """Typed columns out of JSON text; texts cut short are counted as bad, not lost."""
    cut = F.when(F.col("value") < 3, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_type", F.try_parse_json(cut).alias("v"))
    typed = rows.select("event_type", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.col("v").isNull().alias("bad"))
    return typed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("k").alias("n_typed"),
        F.sum("k").alias("sum_k"),
        F.count_if("bad").alias("n_bad"),
    )


@query(
    "job_typed_load",
    """
    SELECT 'good' AS kind, event_type AS item, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM events
    WHERE event_type NOT IN ('error', 'signup') AND value <= 400 GROUP BY event_type
    UNION ALL SELECT 'bad', 'value', count(*), NULL FROM events WHERE event_type = 'error' HAVING count(*) > 0
    UNION ALL SELECT 'bad', 'user_id', count(*), NULL FROM events WHERE event_type = 'signup' HAVING count(*) > 0
    UNION ALL SELECT 'bad', 'ts', count(*), NULL FROM events WHERE value > 400 HAVING count(*) > 0
    """,
)
def job_typed_load(spark, sf_dir):
    """An all-text table becomes a typed table and a reject table, both stored, then both summed up."""
    checked = materialise(conform_checked(damaged_events(spark, sf_dir), EVENT_TYPES, EVENT_FORMATS), "typed")
    good = (
        good_rows(checked)
        .groupBy(F.lit("good").alias("kind"), F.col("event_type").alias("item"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(_money("value")).cast("decimal(28,2)").alias("total"))
    )
    bad = (
        reject_rows(checked, ["event_id"])
        .groupBy(F.lit("bad").alias("kind"), F.col("column").alias("item"))
        .agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("decimal(28,2)").alias("total"))
    )
    return good.unionByName(bad)
