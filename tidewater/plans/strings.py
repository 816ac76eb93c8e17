"""String queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.text import full_match, initcap, instr, split_literal
from tidewater.plans.registry import query
from tidewater.session import table


@query(
    "str_basic",
    """
    SELECT c_custkey, c_mktsegment || '-' || c_name AS s_concat, lower(c_name) AS s_lower, upper(c_name) AS s_upper,
           CAST(length(c_name) AS INTEGER) AS s_length, CAST(octet_length(encode(c_name || 'é')) AS INTEGER) AS s_bytes,
           reverse(c_name) AS s_reverse, repeat(left(c_mktsegment, 2), 3) AS s_repeat
    FROM customer
    """,
)
def str_basic(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat("c_mktsegment", F.lit("-"), "c_name").alias("s_concat"),
        F.lower("c_name").alias("s_lower"),
        F.upper("c_name").alias("s_upper"),
        F.char_length("c_name").alias("s_length"),
        F.octet_length(F.encode(F.concat("c_name", F.lit("é")), "UTF-8")).alias("s_bytes"),
        F.reverse("c_name").alias("s_reverse"),
        F.repeat(F.left("c_mktsegment", F.lit(2)), 3).alias("s_repeat"),
    )


@query(
    "str_slice",
    """
    SELECT p_partkey, substr(p_name, 3, 4) AS s_sub, substr(p_name, -3) AS s_sub_end, left(p_brand, 5) AS s_left,
           right(p_brand, 2) AS s_right, split_part(p_name, ' ', 2) AS s_second, CAST(len(string_split(p_brand, '#')) AS INTEGER) AS n_parts,
           substr(p_name, 1, 3) AS s_bytes
    FROM part
    """,
)
def str_slice(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.substr("p_name", F.lit(3), F.lit(4)).alias("s_sub"),
        F.substr("p_name", F.lit(-3)).alias("s_sub_end"),
        F.left("p_brand", F.lit(5)).alias("s_left"),
        F.right("p_brand", F.lit(2)).alias("s_right"),
        split_literal(F.col("p_name"), " ")[1].alias("s_second"),
        F.size(split_literal(F.col("p_brand"), "#")).alias("n_parts"),
        F.decode(F.substr(F.encode("p_name", "UTF-8"), F.lit(1), F.lit(3)), "UTF-8").alias("s_bytes"),
    )


@query(
    "str_search",
    """
    SELECT p_partkey, CAST(strpos(p_name, 'l') AS INTEGER) AS at_l,
           CAST(CASE WHEN strpos(substr(p_name, 3), 'l') > 0 THEN strpos(substr(p_name, 3), 'l') + 2 ELSE 0 END AS INTEGER) AS at_l_from_3,
           CAST(CASE WHEN strpos(p_name, 'l') > 0 AND strpos(substr(p_name, strpos(p_name, 'l') + 1), 'l') > 0
                THEN strpos(p_name, 'l') + strpos(substr(p_name, strpos(p_name, 'l') + 1), 'l') ELSE 0 END AS INTEGER) AS at_second_l,
           starts_with(p_name, 'small') AS starts, ends_with(p_name, 'bolt') AS ends
    FROM part
    """,
)
def str_search(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.instr(name, "l").alias("at_l"),
        instr(name, "l", start=3).alias("at_l_from_3"),
        instr(name, "l", occurrence=2).alias("at_second_l"),
        name.startswith("small").alias("starts"),
        name.endswith("bolt").alias("ends"),
    )


@query(
    "str_trim_pad",
    """
    SELECT c_custkey, trim('  ' || c_name || ' ') AS s_trim, ltrim(c_name, 'Cus') AS s_ltrim, rtrim(c_name, '0123456789') AS s_rtrim,
           lpad(c_mktsegment, 12, '*') AS s_lpad, rpad(c_mktsegment, 8, '.') AS s_rpad
    FROM customer
    """,
)
def str_trim_pad(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("s_trim"),
        F.ltrim("c_name", F.lit("Cus")).alias("s_ltrim"),
        F.rtrim("c_name", F.lit("0123456789")).alias("s_rtrim"),
        F.lpad("c_mktsegment", 12, "*").alias("s_lpad"),
        F.rpad("c_mktsegment", 8, ".").alias("s_rpad"),
    )


@query(
    "str_replace",
    """
    SELECT p_partkey, replace(p_name, 'bolt', 'screw') AS s_replace, translate(p_brand, '#123', '-abc') AS s_translate,
           upper(left(p_type, 1)) || lower(substr(p_type, 2)) || '-' || upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2)
             || ' ' || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) AS s_initcap,
           CASE p_type WHEN 'STANDARD' THEN 'S353' WHEN 'ECONOMY' THEN 'E255' WHEN 'SMALL' THEN 'S540'
                WHEN 'LARGE' THEN 'L620' WHEN 'PROMO' THEN 'P650' WHEN 'MEDIUM' THEN 'M350' END AS s_soundex
    FROM part
    """,
)
def str_replace(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.replace("p_name", F.lit("bolt"), F.lit("screw")).alias("s_replace"),
        F.translate("p_brand", "#123", "-abc").alias("s_translate"),
        initcap(F.concat_ws("-", "p_type", "p_name"), " -").alias("s_initcap"),
        F.soundex("p_type").alias("s_soundex"),
    )


@query(
    "regex",
    r"""
    SELECT doc_id, regexp_matches(text, '[A-Z]{4,}') AS has_caps, regexp_extract(text, '([0-9]{3})-[0-9]{4}', 1) AS phone_part,
           CAST(len(regexp_extract_all(text, '[0-9]+')) AS INTEGER) AS n_numbers, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS masked,
           regexp_full_match(lang, '[a-d]e|f.') AS lang_match,
           CAST(CASE WHEN regexp_matches(text, '[0-9]') THEN length(regexp_extract(text, '^([^0-9]*)[0-9]', 1)) + 1 ELSE 0 END AS INTEGER) AS first_digit
    FROM documents
    """,
)
def regex(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.rlike(text, F.lit("[A-Z]{4,}")).alias("has_caps"),
        F.regexp_extract(text, "([0-9]{3})-[0-9]{4}", 1).alias("phone_part"),
        F.size(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))).alias("n_numbers"),
        F.md5(F.regexp_replace(text, "[0-9]+", "#")).alias("masked"),
        full_match(F.col("lang"), "[a-d]e|f.").alias("lang_match"),
        F.regexp_instr(text, F.lit("[0-9]")).alias("first_digit"),
    )


@query(
    "str_codepoint",
    """
    SELECT c_custkey, CAST(ascii(c_name) AS INTEGER) AS first_ascii, CAST(unicode(c_mktsegment) AS INTEGER) AS first_unicode,
           chr(CAST(65 + c_custkey % 26 AS INTEGER)) AS letter
    FROM customer
    """,
)
def str_codepoint(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.ascii("c_name").alias("first_ascii"),
        F.ascii("c_mktsegment").alias("first_unicode"),
        F.chr(F.lit(65) + F.col("c_custkey") % 26).alias("letter"),
    )


@query(
    "str_format",
    "SELECT o_orderkey, format('{:08d}', o_orderkey) || ' ' || printf('%-16s|', o_orderpriority) || printf('%.2f', o_totalprice) AS line FROM orders",
)
def str_format(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.format_string("%08d %-16s|%.2f", "o_orderkey", "o_orderpriority", "o_totalprice").alias("line")
    )


@query(
    "str_collate",
    """
    SELECT lower(seg) AS segment, count(*) AS n FROM (
      SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS seg FROM customer) GROUP BY lower(seg)
    """,
)
def str_collate(spark, sf_dir):
    """Groups that ignore case, through a case-blind collation."""
    mixed = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    grouped = (
        table(spark, sf_dir, "customer")
        .groupBy(F.collate(mixed, "UTF8_LCASE").alias("seg"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return grouped.select(F.lower(F.collate("seg", "UTF8_BINARY")).alias("segment"), "n")


@query(
    "utf8_clean",
    "SELECT doc_id, md5(text || chr(65533) || 'x') AS cleaned, CAST(length(text) + 2 AS INTEGER) AS n_chars FROM documents",
)
def utf8_clean(spark, sf_dir):
    """Whole texts with a stray byte in them; the byte becomes the replacement character."""
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.lit("x"), "UTF-8"))
    cleaned = F.make_valid_utf8(broken.cast("string"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(cleaned).alias("cleaned"), F.char_length(cleaned).alias("n_chars")
    )
