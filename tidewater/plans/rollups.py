"""Duplicate groups, stable buckets, host and area roll-ups."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import fixed, sum_fixed
from tidewater.operators.dedup import content_groups, host_of, last_labels, stable_bucket
from tidewater.plans.registry import query
from tidewater.session import table


@query(
    "content_dedup",
    """
    SELECT sha256(text) AS digest, min(doc_id) AS kept, count(*) AS n_copies, md5(any_value(text)) AS check_md5
    FROM documents GROUP BY sha256(text)
    """,
)
def content_dedup(spark, sf_dir):
    """Exact-duplicate groups of whole texts; the smallest id is kept."""
    return content_groups(table(spark, sf_dir, "documents"), "text", "doc_id", F.min(F.md5("text")).alias("check_md5"))


BUCKETS = 16


@query(
    "stable_bucket",
    "SELECT sha256(text) AS digest, count(*) AS n_copies, true AS in_range, 1::BIGINT AS n_buckets FROM documents GROUP BY sha256(text)",
)
def stable_bucket_query(spark, sf_dir):
    """Buckets from the whole text: always in range, and equal texts share one."""
    per_bucket = (
        table(spark, sf_dir, "documents")
        .groupBy(F.sha2("text", 256).alias("digest"), stable_bucket(["text"], BUCKETS, seed=11).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_bucket.groupBy("digest").agg(
        F.sum("n").alias("n_copies"),
        F.bool_and(F.col("bucket").between(0, BUCKETS - 1)).alias("in_range"),
        F.count("bucket").alias("n_buckets"),
    )


@query(
    "host_rollup",
    r"""
    SELECT host, regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS domain, regexp_extract(host, '([^.]+)$', 1) AS suffix,
           count(*) AS n_pages, CAST(sum(length(html)) AS BIGINT) AS n_chars
    FROM (SELECT *, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host FROM pages) GROUP BY host
    """,
)
def host_rollup(spark, sf_dir):
    hosts = (
        table(spark, sf_dir, "pages")
        .groupBy(host_of("url").alias("host"))
        .agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("html")).alias("n_chars"))
    )
    return hosts.select(
        "host",
        last_labels(F.col("host"), 2).alias("domain"),
        last_labels(F.col("host"), 1).alias("suffix"),
        "n_pages",
        "n_chars",
    )


@query(
    "geo_area_rollup",
    """
    SELECT CAST(CASE WHEN grouping(r_name) = 1 THEN 'all' WHEN grouping(n_name) = 1 THEN 'region' ELSE 'country' END AS VARCHAR) AS level,
           r_name AS region, n_name AS country, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name)
    """,
)
def geo_area_rollup(spark, sf_dir):
    """Orders by country, region and world. Facts shrink to one row per country before the roll-up."""
    t = lambda name: table(spark, sf_dir, name)
    per_customer = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), sum_fixed(fixed(F.col("o_totalprice"))).alias("s"))
    per_nation = (
        per_customer.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    areas = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        per_nation.join(areas, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("r_name").alias("region"), F.col("n_name").alias("country"), "n", "s")
        .rollup("region", "country")
        .agg(
            F.sum("n").alias("n_orders"),
            F.sum("s").cast("decimal(28,2)").alias("total"),
            F.when(F.grouping("region") == 1, "all")
            .when(F.grouping("country") == 1, "region")
            .otherwise("country")
            .alias("level"),
        )
    )
