"""Scans, sources and sinks."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import fixed, sum_fixed
from tidewater.plans.registry import query
from tidewater.session import materialise, scratch_path, table, table_path
from tidewater.sources.catalog import (
    browse,
    dry_run,
    hide,
    named_table,
    native_query,
    schema_rows,
    select_star,
)
from tidewater.sources.generator import generate_rows
from tidewater.sources.layouts import partitioned
from tidewater.sources.sinks import PAGE_BYTES, export_files, export_pages, profile_files, read_profile

ORDER_TOTALS_SQL = """
SELECT {key}, count(*) AS n_rows, CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM {table} {where} GROUP BY {key}
"""


def _totals(df, key, value):
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), sum_fixed(fixed(F.col(value))).alias("total")
    )


@query("scan_partitioned", "SELECT * FROM orders")
def scan_partitioned(spark, sf_dir):
    """A whole table; Spark cuts its files into byte ranges and reads them side by side."""
    return table(spark, sf_dir, "orders")


@query("scan_single", "SELECT * FROM customer")
def scan_single(spark, sf_dir):
    """A read by name alone, without any hint on how to split it."""
    return table(spark, sf_dir, "customer")


@query(
    "scan_concurrency_cap",
    ORDER_TOTALS_SQL.format(key="l_returnflag", value="l_extendedprice", table="lineitem", where=""),
)
def scan_concurrency_cap(spark, sf_dir):
    """At most as many tasks read as the session has cores: neighbouring splits share a task."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return _totals(lines.coalesce(spark.sparkContext.defaultParallelism), "l_returnflag", "l_extendedprice")


@query(
    "scan_empty",
    "SELECT count(*) AS n_rows, max(o_orderkey) AS last_key, sum(o_totalprice) AS total FROM orders WHERE o_totalprice < 0",
)
def scan_empty(spark, sf_dir):
    """Totals over a scan that finds nothing: one row, no rows counted, NULL totals."""
    none = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") < 0)
    return none.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("o_orderkey").alias("last_key"), F.sum("o_totalprice").alias("total")
    )


NATIVE_TEXT = """
SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS decimal(28,2)) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > {marker}
GROUP BY c_mktsegment, o_orderstatus
"""


@query("scan_native_query", NATIVE_TEXT.format(marker="100000.0"))
def scan_native_query(spark, sf_dir):
    return native_query(
        spark,
        NATIVE_TEXT.format(marker=":floor"),
        {name: table(spark, sf_dir, name) for name in ("orders", "customer")},
        {"floor": 100000.0},
    )


@query("scan_named_table", "SELECT * FROM supplier")
def scan_named_table(spark, sf_dir):
    return named_table(spark, ["supplier"], root=sf_dir)


@query(
    "scan_nested_source",
    """
    SELECT n_orders, count(*) AS n_customers FROM (
      SELECT o_custkey, count(*) AS n_orders FROM (SELECT * FROM orders WHERE o_totalprice > 50000) GROUP BY o_custkey
    ) GROUP BY n_orders
    """,
)
def scan_nested_source(spark, sf_dir):
    big = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 50000)
    per_customer = big.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return per_customer.groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_customers"))


@query(
    "scan_project_pushdown",
    ORDER_TOTALS_SQL.format(key="l_linestatus", value="l_extendedprice", table="lineitem", where=""),
)
def scan_project_pushdown(spark, sf_dir):
    return _totals(table(spark, sf_dir, "lineitem"), "l_linestatus", "l_extendedprice")


@query(
    "scan_filter_pushdown",
    ORDER_TOTALS_SQL.format(
        key="l_returnflag",
        value="l_extendedprice",
        table="lineitem",
        where="WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity > 40 AND l_extendedprice % 2 < 1",
    ),
)
def scan_filter_pushdown(spark, sf_dir):
    """Two filters reach the parquet scan; the remainder test does not and Spark applies it."""
    kept = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("l_quantity") > 40)
        & (F.col("l_extendedprice") % 2 < 1)
    )
    return _totals(kept, "l_returnflag", "l_extendedprice")


@query(
    "scan_partition_pruning",
    """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS p_date, count(*) AS n_events FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY event_type, p_date
    """,
)
def scan_partition_pruning(spark, sf_dir):
    """Events laid out by day, once; a range filter on the day reads only those folders."""
    days = _events_by_day(spark, sf_dir).filter(
        F.col("p_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-19").cast("date"))
    )
    return days.groupBy("event_type", F.date_format("p_date", "yyyy-MM-dd").alias("p_date")).agg(
        F.count(F.lit(1)).alias("n_events")
    )


def _events_by_day(spark, sf_dir):
    return partitioned(spark, table_path(sf_dir, "events"), {"p_date": F.to_date("ts")})


@query(
    "scan_dynamic_pruning",
    """
    SELECT e.event_type, count(*) AS n_events, count(DISTINCT e.user_id) AS n_users FROM events e
    JOIN (SELECT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error' GROUP BY d HAVING count(*) FILTER (value > 90) > 0 AND dayofweek(d) IN (0, 6)) w
    ON CAST(e.ts AS DATE) = w.d GROUP BY e.event_type
    """,
)
def scan_dynamic_pruning(spark, sf_dir):
    """Events of the weekend days with a large error: which folders are read is known only once the days are."""
    events = _events_by_day(spark, sf_dir)
    errors = events.filter(F.col("event_type") == "error").groupBy("p_date").agg(F.count_if(F.col("value") > 90).alias("n_large"))
    days = materialise(errors.withColumn("weekend", F.dayofweek("p_date").isin(1, 7)), "days")
    wanted = days.filter(F.col("weekend") & (F.col("n_large") > 0)).select("p_date")
    return events.join(wanted, "p_date").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users")
    )


def _gen_sql(column: str, kind: str) -> str:
    digest = f"md5(c_custkey || '|{column}|7')"
    if kind == "bigint":
        return f"CAST(('0x' || substr({digest},1,8))::BIGINT % 100 AS BIGINT) AS {column}"
    letters = "||".join(f"chr(97 + CAST(('0x' || substr({digest},{2 * i + 1},2))::BIGINT % 26 AS INTEGER))" for i in range(10))
    return f"{letters} AS {column}"


GEN_LAYOUT = {"first_name": "string", "last_name": "string", "age": "bigint"}


@query(
    "gen_rows",
    "SELECT c_custkey, " + ", ".join(_gen_sql(c, t) for c, t in GEN_LAYOUT.items()) + " FROM customer",
)
def gen_rows(spark, sf_dir):
    """One made-up person per customer key."""
    return generate_rows(table(spark, sf_dir, "customer"), "c_custkey", GEN_LAYOUT, seed=7)


SAMPLE_PARTS, SAMPLE_SEED = 16, 42


@query(
    "scan_split_sample",
    f"SELECT * FROM orders WHERE ('0x' || substr(md5(o_orderkey || '|{SAMPLE_SEED}'), 1, 8))::BIGINT % {SAMPLE_PARTS} = 0",
)
def scan_split_sample(spark, sf_dir):
    """One of sixteen equal parts of a table, by a seeded hash of the key: the same rows on every run."""
    digest = F.md5(F.concat_ws("|", "o_orderkey", F.lit(SAMPLE_SEED)).cast("binary"))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SAMPLE_PARTS
    return table(spark, sf_dir, "orders").filter(part == 0)


#: Given tables, for the check SQL; the query itself lists the folder.
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(
    "catalog_browse",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, '{t.capitalize()}' AS display_name, true AS is_leaf, (SELECT count(*) FROM {t}) AS n_rows"
        for t in TABLES
    ),
)
def catalog_browse(spark, sf_dir):
    """All tables of the source folder with their row counts (taken from file footers)."""
    found, counts = browse(spark, sf_dir).drop("parent"), None
    for name in sorted(r["name"] for r in found.select("name").collect()):
        one = table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return found.join(counts, "name")


@query(
    "resolve_schema",
    " UNION ALL ".join(
        f"SELECT CAST(ordinal_position - 1 AS INTEGER) AS pos, column_name AS path, CASE data_type "
        f"WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
        f"ELSE 'timestamp_ntz' END AS type, true AS nullable, 'REGULAR' AS visibility, "
        f"'{t}' AS origin FROM information_schema.columns WHERE table_name = '{t}'"
        for t in ("orders", "documents")
    ),
)
def resolve_schema(spark, sf_dir):
    """Schema rows of two tables, from file footers: no row is read."""
    one = lambda name: schema_rows(table(spark, sf_dir, name)).withColumn("origin", F.lit(name))
    return one("orders").unionByName(one("documents"))


@query(
    "hidden_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders WHERE o_totalprice > 200000",
)
def hidden_columns(spark, sf_dir):
    orders = hide(table(spark, sf_dir, "orders"), "o_totalprice")
    return select_star(orders.filter(F.col("o_totalprice") > 200000))


STREAM_ROWS = 1000

PAGES_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, doc_id // {STREAM_ROWS} AS stream_no,
         row_number() OVER (PARTITION BY doc_id // {STREAM_ROWS} ORDER BY doc_id) AS rn,
         CAST(octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)) + 24 AS BIGINT) AS row_bytes
  FROM documents
), packed AS (
  SELECT stream_no, rn, doc_id, row_bytes, 0 AS page_no, row_bytes AS filled FROM rows WHERE rn = 1
  UNION ALL
  SELECT r.stream_no, r.rn, r.doc_id, r.row_bytes,
         CASE WHEN p.filled >= {PAGE_BYTES} THEN p.page_no + 1 ELSE p.page_no END,
         CASE WHEN p.filled >= {PAGE_BYTES} THEN r.row_bytes ELSE p.filled + r.row_bytes END
  FROM packed p JOIN rows r ON r.stream_no = p.stream_no AND r.rn = p.rn + 1
)
SELECT stream_no, CAST(page_no AS INTEGER) AS page_no, count(*) AS n_rows, min(doc_id) AS first_doc,
       CAST(sum(row_bytes) AS BIGINT) AS page_bytes
FROM packed GROUP BY stream_no, page_no
"""


@query("export_pages", PAGES_SQL)
def export_pages_query(spark, sf_dir):
    """Documents packed into pages, one stream per 1,000 consecutive ids."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "stream_no", F.expr(f"doc_id div {STREAM_ROWS}")
    )
    written = export_pages(documents, "stream_no", ["doc_id"], scratch_path(spark, "pages"))
    return written.groupBy("stream_no", "page_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("doc_id").alias("first_doc"),
        F.sum("row_bytes").alias("page_bytes"),
    )


@query(
    "export_files",
    "SELECT * FROM (VALUES ('csv'), ('json'), ('parquet')) f(format), ("
    "SELECT o_orderstatus, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total "
    "FROM orders GROUP BY o_orderstatus)",
)
def export_files_query(spark, sf_dir):
    """A per-status summary after a trip through each file format."""
    orders = table(spark, sf_dir, "orders")
    out = None
    for fmt, options in (("parquet", {}), ("json", {}), ("csv", {"header": "true"})):
        back = export_files(orders, fmt, **options)
        one = _totals(back, "o_orderstatus", "o_totalprice").withColumn("format", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "read_profile",
    "SELECT l_linestatus AS slot, count(*) AS n_rows, CAST(sum(68 + octet_length(encode(l_returnflag)) "
    "+ octet_length(encode(l_linestatus))) AS BIGINT) AS n_bytes FROM lineitem GROUP BY l_linestatus",
)
def read_profile_query(spark, sf_dir):
    """Rows and payload bytes per line status; the default slot is the input partition."""
    return read_profile(table(spark, sf_dir, "lineitem"), F.col("l_linestatus"))


@query(
    "read_profile_files",
    "SELECT 'lineitem.parquet' AS file, count(*) AS n_rows, CAST(sum(68 + octet_length(encode(l_returnflag)) "
    "+ octet_length(encode(l_linestatus))) AS BIGINT) AS n_bytes, true AS times_hold, true AS all_observed FROM lineitem",
)
def read_profile_files(spark, sf_dir):
    """Rows, bytes and times of a read by input file; the times are checked, not returned, as no two runs agree on them."""
    profile, observed = profile_files(table(spark, sf_dir, "lineitem"))
    per_split = (
        (F.col("first_seconds") > 0) & (F.col("first_seconds") <= F.col("seconds")) & (F.col("bytes_per_second") > 0)
    )
    files = profile.groupBy("file").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"), F.bool_and(per_split).alias("times_hold")
    )
    whole = profile.agg(F.sum("n_rows").alias("r"), F.sum("n_bytes").alias("b")).first()
    agree = (whole["r"], whole["b"]) == (observed["n_rows"], observed["n_bytes"])
    return files.withColumn("all_observed", F.lit(agree))


DRY_TEXT = "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey"


@query(
    "scan_dry_run",
    f"""
    WITH r AS ({DRY_TEXT})
    SELECT 'o_custkey' AS path, 'bigint' AS type, count(o_custkey) AS n_values, CAST(sum(o_custkey) AS BIGINT) AS total FROM r
    UNION ALL SELECT 'n_orders', 'bigint', count(n_orders), CAST(sum(n_orders) AS BIGINT) FROM r
    """,
)
def scan_dry_run(spark, sf_dir):
    """The schema a query was checked to have, beside what its run then holds in each column."""
    tables = {"orders": table(spark, sf_dir, "orders")}
    schema = dry_run(spark, DRY_TEXT, tables)
    ran = native_query(spark, DRY_TEXT, tables)
    held = ran.agg(*[F.struct(F.count(f.name).alias("n"), F.sum(f.name).alias("t")).alias(f.name) for f in schema.fields])
    rows = [F.struct(F.lit(f.name).alias("path"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"{f.name}.n").alias("n_values"), F.col(f"{f.name}.t").alias("total")) for f in schema.fields]
    return held.select(F.inline(F.array(*rows)))
