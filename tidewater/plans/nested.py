"""Array, map, range and JSON queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.nested import (
    array_avg,
    array_find,
    array_includes_all,
    array_is_distinct,
    array_offset,
    array_offsets,
    array_sum,
)
from tidewater.operators.ranges import container_counts, containers, make_range, overlap_counts, overlap_join
from tidewater.plans.registry import query
from tidewater.session import table

def _text(a):
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


@query(
    "arr_build",
    """
    SELECT vec_id, concat_ws(',', label, label + 1, label * 2) AS made, array_to_string(generate_series(0, label, 2), ',') AS series,
           concat_ws(',', label, vec_id, label) AS joined, concat_ws(',', label, label, vec_id) AS flat,
           embedding[64] AS reversed_first, CAST(len(embedding) * 2 AS INTEGER) AS doubled
    FROM embeddings
    """,
)
def arr_build(spark, sf_dir):
    label, key, e = F.col("label"), F.col("vec_id"), F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        _text(F.array(label, label + 1, label * 2)).alias("made"),
        _text(F.sequence(F.lit(0), label, F.lit(2))).alias("series"),
        _text(F.concat(F.array(label.cast("bigint"), key), F.array(label.cast("bigint")))).alias("joined"),
        _text(F.flatten(F.array(F.array(label.cast("bigint"), label.cast("bigint")), F.array(key)))).alias("flat"),
        F.reverse(e)[0].alias("reversed_first"),
        F.size(F.concat(e, e)).alias("doubled"),
    )


@query(
    "arr_access",
    """
    SELECT vec_id, embedding[1] AS at_offset_0, embedding[3] AS at_ordinal_3, embedding[100] AS safe_at_100, embedding[1] AS first_one,
           embedding[len(embedding)] AS last_one, CAST(len(embedding) AS INTEGER) AS n,
           round(list_sum(list_transform(embedding[11:20], lambda x: x::DOUBLE)), 6) AS slice_sum
    FROM embeddings
    """,
)
def arr_access(spark, sf_dir):
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        e[0].alias("at_offset_0"),
        F.element_at(e, 3).alias("at_ordinal_3"),
        F.try_element_at(e, F.lit(100)).alias("safe_at_100"),
        F.get(e, F.lit(0)).alias("first_one"),
        F.element_at(e, -1).alias("last_one"),
        F.size(e).alias("n"),
        F.round(array_sum(F.slice(e, 11, 10)), 6).alias("slice_sum"),
    )


@query(
    "arr_hof",
    """
    SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
           round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * (i - 1))), 6) AS weighted,
           len(list_filter(embedding, lambda x: x > 0.25)) > 0 AS any_large, list_contains(embedding, embedding[5]) AS has_fifth,
           list_has_any([label, 3, 5], [3, 7]) AS shares, list_has_all([label, 3, 5], [3, label]) AS covers,
           CAST(len(list_filter(embedding, lambda x, i: i % 2 = 1 AND x < 0)) AS INTEGER) AS n_even_negative
    FROM embeddings
    """,
)
def arr_hof(spark, sf_dir):
    e, label = F.col("embedding"), F.col("label")
    three = F.array(label, F.lit(3), F.lit(5))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.size(F.filter(e, lambda x: x > 0)).alias("n_positive"),
        F.round(array_sum(F.transform(e, lambda x, i: x.cast("double") * i)), 6).alias("weighted"),
        F.exists(e, lambda x: x > 0.25).alias("any_large"),
        F.array_contains(e, F.element_at(e, 5)).alias("has_fifth"),
        F.arrays_overlap(three, F.array(F.lit(3), F.lit(7))).alias("shares"),
        array_includes_all(three, F.array(F.lit(3), label)).alias("covers"),
        F.size(F.filter(e, lambda x, i: (i % 2 == 0) & (x < 0))).alias("n_even_negative"),
    )


@query(
    "arr_agg",
    """
    SELECT vec_id, round(list_sum(v), 6) AS total, round(list_sum(v) / 64, 6) AS mean, list_min(embedding) AS lowest,
           list_max(embedding) AS highest, CAST(list_sum([label, vec_id, 7]) AS BIGINT) AS int_total
    FROM (SELECT *, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
    """,
)
def arr_agg(spark, sf_dir):
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.round(array_sum(e), 6).alias("total"),
        F.round(array_avg(e), 6).alias("mean"),
        F.array_min(e).alias("lowest"),
        F.array_max(e).alias("highest"),
        array_sum(F.array(F.col("label").cast("bigint"), F.col("vec_id"), F.lit(7).cast("bigint")), "bigint").alias("int_total"),
    )


def _roles(spark, sf_dir):
    """The roles of each whole conversation, in order of its turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "role").alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return whole.select("conv_id", F.col("ts.role").alias("roles"))


ROLES_SQL = "(SELECT conv_id, list(role ORDER BY turn) AS roles FROM conversations GROUP BY ALL)"


@query(
    "arr_find",
    f"""
    SELECT conv_id, CAST(list_position(roles, 'assistant') - 1 AS BIGINT) AS first_reply,
           array_to_string(list_transform(list_filter(list_transform(roles, lambda r, i: CASE WHEN r = 'user' THEN i - 1 END), lambda i: i IS NOT NULL), lambda i: CAST(i AS VARCHAR)), ',') AS user_turns,
           list_filter(roles, lambda r: r <> 'user')[1] AS first_other, CAST(len(list_filter(roles, lambda r: r = 'user')) AS INTEGER) AS n_user,
           len(list_distinct(roles)) = len(roles) AS is_distinct
    FROM {ROLES_SQL}
    """,
)
def arr_find(spark, sf_dir):
    """Offsets and finds in the roles of whole conversations."""
    roles = F.col("roles")
    return _roles(spark, sf_dir).select(
        "conv_id",
        array_offset(roles, F.lit("assistant")).alias("first_reply"),
        _text(array_offsets(roles, F.lit("user"))).alias("user_turns"),
        array_find(roles, lambda r: r != "user").alias("first_other"),
        F.size(F.filter(roles, lambda r: r == "user")).alias("n_user"),
        array_is_distinct(roles).alias("is_distinct"),
    )


@query(
    "arr_to_string",
    f"""
    SELECT conv_id, array_to_string(roles, ' > ') AS plain,
           array_to_string(list_transform(roles, lambda r: coalesce(nullif(r, 'system'), '(none)')), '|') AS with_nulls
    FROM {ROLES_SQL}
    """,
)
def arr_to_string(spark, sf_dir):
    gaps = F.transform("roles", lambda r: F.nullif(r, F.lit("system")))
    return _roles(spark, sf_dir).select(
        "conv_id", F.array_join("roles", " > ").alias("plain"), F.array_join(gaps, "|", "(none)").alias("with_nulls")
    )


@query(
    "map_ops",
    """
    SELECT event_id, k AS at_key, CAST(NULL AS BIGINT) AS at_missing, true AS has_k, user_id AS set_u, k + 1 AS set_k, 1::INTEGER AS n_without_k
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    """,
)
def map_ops(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("m", F.from_json("props", "map<string,bigint>"))
    m = F.col("m")
    changes = F.create_map(F.lit("k"), m["k"] + 1, F.lit("u"), F.col("user_id"))
    kept = F.map_filter(m, lambda k, v: ~k.isin("k", "u"))
    modified = F.map_concat(kept, changes)
    return events.select(
        "event_id",
        F.element_at(m, "k").alias("at_key"),
        F.try_element_at(m, F.lit("zz")).alias("at_missing"),
        F.map_contains_key(m, "k").alias("has_k"),
        F.element_at(modified, "u").alias("set_u"),
        F.element_at(modified, "k").alias("set_k"),
        F.size(F.map_filter(modified, lambda k, v: k != "k")).alias("n_without_k"),
    )


@query(
    "arr_unnest",
    """
    SELECT CAST(pos - 1 AS INTEGER) AS pos, count(*) AS n, count(*) FILTER (WHERE x > 0) AS n_positive, max(x) AS highest
    FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY pos
    """,
)
def arr_unnest(spark, sf_dir):
    parts = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    return parts.groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") > 0).alias("n_positive"), F.max("x").alias("highest")
    )


@query(
    "range_overlap",
    """
    SELECT p.event_id, count(e.event_id) AS n_overlaps FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
    ON e.ts < p.ts + INTERVAL 30 MINUTE AND p.ts < e.ts + INTERVAL 5 MINUTE GROUP BY p.event_id
    """,
)
def range_overlap(spark, sf_dir):
    """For each half hour after a purchase, how many five-minute error windows overlap it."""
    events = table(spark, sf_dir, "events")

    def ranged(kind, length):
        span = make_range(F.col("ts"), F.col("ts") + F.expr(f"INTERVAL {length}"))
        return events.filter(F.col("event_type") == kind).select("event_id", span.alias("r")).select("event_id", "r.*")

    counted = overlap_counts(ranged("purchase", "30 MINUTE"), ranged("error", "5 MINUTE"), "start", "end")
    return counted.select("event_id", "n_overlaps")


# Error windows of five minutes and purchase windows of half an hour; some have no end, some purchases no start.
_SPANS = """
    WITH e AS (SELECT event_id, ts AS s, CASE WHEN value >= 2 THEN ts + INTERVAL 5 MINUTE END AS t FROM events WHERE event_type = 'error'),
         p AS (SELECT event_id, CASE WHEN value < 97 THEN ts END AS s, CASE WHEN value >= 3 THEN ts + INTERVAL 30 MINUTE END AS t
               FROM events WHERE event_type = 'purchase')
"""


def _spans(spark, sf_dir):
    events, value = table(spark, sf_dir, "events"), F.col("value")
    later = lambda text: F.col("ts") + F.expr(f"INTERVAL {text}")
    of = lambda kind, start, end: events.filter(F.col("event_type") == kind).select(
        "event_id", start.alias("start"), end.alias("end")
    )
    errors = of("error", F.col("ts"), F.when(value >= 2, later("5 MINUTE")))
    return errors, of("purchase", F.when(value < 97, F.col("ts")), F.when(value >= 3, later("30 MINUTE")))


@query(
    "range_containment",
    _SPANS
    + """
    SELECT e.event_id, count(p.event_id) AS n_containers, arg_max(p.event_id, (coalesce(p.t, TIMESTAMP '9999-12-31'), p.event_id)) AS container
    FROM e LEFT JOIN p ON coalesce(p.s, TIMESTAMP '0001-01-01') <= e.s
                      AND coalesce(e.t, TIMESTAMP '9999-12-31') <= coalesce(p.t, TIMESTAMP '9999-12-31')
    GROUP BY e.event_id
    """,
)
def range_containment(spark, sf_dir):
    """How many purchase windows hold each error window, and which of them ends last."""
    errors, purchases = _spans(spark, sf_dir)
    held = containers(errors, purchases, "start", "end", "event_id")
    return container_counts(held, purchases, "start", "end").select("event_id", "n_containers", "container")


@query(
    "range_pairs",
    """
    SELECT p.event_id AS purchase_id, e.event_id AS error_id FROM events p, events e
    WHERE p.event_type = 'purchase' AND e.event_type = 'error'
      AND e.ts < p.ts + INTERVAL 30 MINUTE AND p.ts < e.ts + INTERVAL 5 MINUTE
    """,
)
def range_pairs(spark, sf_dir):
    """The overlapping pairs themselves: half hours after a purchase and five-minute error windows."""
    events = table(spark, sf_dir, "events")

    def spans(kind, prefix, length):
        end = F.col("ts") + F.expr(f"INTERVAL {length}")
        own = events.filter(F.col("event_type") == kind)
        return own.select(F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_start"), end.alias(f"{prefix}_end"))

    pairs = overlap_join(
        spans("purchase", "purchase", "30 MINUTE"), spans("error", "error", "5 MINUTE"),
        ("purchase_start", "purchase_end"), ("error_start", "error_end"), "30 MINUTE",
    )
    return pairs.select("purchase_id", "error_id")


@query(
    "json_scalar",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k_text, json_extract_string(j, '$.who.id') AS user_text,
           json_extract(j, '$.tags[1]')::VARCHAR AS second_tag_json, json_extract_string(j, '$.none') AS missing,
           CAST(json_extract(j, '$.who') AS VARCHAR) AS who_json
    FROM (SELECT *, json_object('who', json_object('id', user_id), 'tags', json_array(event_type, 'x')) AS j FROM events)
    """,
)
def json_scalar(spark, sf_dir):
    """Scalars as text, subtrees as JSON; the same paths through text and through parsed values."""
    made = F.to_json(
        F.struct(F.struct(F.col("user_id").alias("id")).alias("who"), F.array("event_type", F.lit("x")).alias("tags"))
    )
    rows = table(spark, sf_dir, "events").withColumn("j", made).withColumn("v", F.parse_json("j"))
    return rows.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("j", "$.who.id").alias("user_text"),
        F.to_json(F.variant_get("v", "$.tags[1]", "variant")).alias("second_tag_json"),
        F.variant_get("v", "$.none", "string").alias("missing"),
        F.to_json(F.variant_get("v", "$.who", "variant")).alias("who_json"),
    )


@query(
    "json_array",
    """
    SELECT item, count(*) AS n, CAST(sum(n_items) AS BIGINT) AS n_items FROM (
      SELECT unnest(CAST(a AS VARCHAR[])) AS item, json_array_length(a) AS n_items
      FROM (SELECT json_array(event_type, CAST(user_id % 3 AS VARCHAR)) AS a FROM events)) GROUP BY item
    """,
)
def json_array(spark, sf_dir):
    made = F.to_json(F.array("event_type", (F.col("user_id") % 3).cast("string")))
    rows = table(spark, sf_dir, "events").select(made.alias("a"))
    items = rows.select(F.explode(F.from_json("a", "array<string>")).alias("item"), F.json_array_length("a").alias("n_items"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum("n_items").alias("n_items"))


@query(
    "json_write",
    """
    SELECT o_orderkey, CAST(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'lines': [o_custkey, o_orderkey]}) AS VARCHAR) AS js,
           CAST(to_json([o_orderstatus, o_orderpriority]) AS VARCHAR) AS arr
    FROM orders
    """,
)
def json_write(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_json(F.struct("o_orderkey", "o_orderstatus", F.array("o_custkey", "o_orderkey").alias("lines"))).alias("js"),
        F.to_json(F.to_variant_object(F.array("o_orderstatus", "o_orderpriority"))).alias("arr"),
    )


@query(
    "json_parse_typed",
    """
    SELECT event_id, CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k_int,
           CASE WHEN ok THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k_double,
           CASE WHEN ok THEN json_extract_string(props, '$.k') END AS k_string, CAST(NULL AS BOOLEAN) AS k_bool,
           CASE WHEN ok THEN 'OBJECT<k: BIGINT>' END AS json_type, NOT ok AS is_bad
    FROM (SELECT *, event_type <> 'error' AS ok FROM events)
    """,
)
def json_parse_typed(spark, sf_dir):
    """Typed values out of JSON; texts that lost their last character parse to NULL and are marked."""
    text = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("t"), F.try_parse_json(text).alias("v"))
    return rows.select(
        "event_id",
        F.try_variant_get("v", "$.k", "bigint").alias("k_int"),
        F.try_variant_get("v", "$.k", "double").alias("k_double"),
        F.try_variant_get("v", "$.k", "string").alias("k_string"),
        F.try_variant_get("v", "$.flag", "boolean").alias("k_bool"),
        F.schema_of_variant("v").alias("json_type"),
        (F.col("t").isNotNull() & F.col("v").isNull()).alias("is_bad"),
    )
