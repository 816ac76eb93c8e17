"""Parquet scans, catalogue views and the row generator."""
import datetime as dt
import io
from contextlib import redirect_stdout

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sources.catalog import (
    browse,
    browse_catalog,
    check_names,
    dry_run,
    hide,
    named_table,
    native_query,
    schema_rows,
    select_star,
    with_display_name,
)
from tidewater.sources.generator import generate_rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files, 2,000 rows, many row groups."""
    path = tmp_path_factory.mktemp("splits") / "t"
    path.mkdir()
    start = dt.datetime(2024, 1, 1)
    for f, n in enumerate((1000, 700, 300)):
        ids = list(range(f * 10_000, f * 10_000 + n))
        t = pa.table(
            {
                "id": pa.array(ids, pa.int64()),
                "name": [f"name-{i}" for i in ids],
                "v": [i / 10 if i % 7 else None for i in ids],
                "ts": pa.array([start + dt.timedelta(minutes=i) for i in ids], pa.timestamp("us")),
                "tags": [[i, i + 1] for i in ids],
            }
        )
        pq.write_table(t, path / f"part-{f}.parquet", row_group_size=50)
    return str(path)


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def scanned(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_columns_and_filters_reach_the_scan(spark, folder):
    kept = spark.read.parquet(folder).filter((F.col("id") >= 100) & F.col("v").isNotNull()).select("id", "v")
    text = scanned(kept)
    assert "ReadSchema: struct<id:bigint,v:double>" in text
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(id,100)" in pushed and "IsNotNull(v)" in pushed
    assert kept.count() == sum(1 for f, n in enumerate((1000, 700, 300)) for i in range(f * 10_000, f * 10_000 + n) if i >= 100 and i % 7)


def test_pushed_filters_keep_nan_and_drop_null(spark, tmp_path):
    values = [1.0, 5.0, 10.0, float("nan"), None]
    pq.write_table(pa.table({"x": pa.array(values, pa.float64())}), tmp_path / "t.parquet")
    df = spark.read.parquet(str(tmp_path))
    got = lambda test: sorted(str(r["x"]) for r in df.filter(test).collect())
    assert got("x > 5") == ["10.0", "nan"] and got("x >= 5") == ["10.0", "5.0", "nan"]
    assert got("x IN (10.0, NULL)") == ["10.0"]


def test_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "by-day")
    spark.range(100).withColumn("day", F.col("id") % 10).write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path).filter("day = 3")
    assert "PartitionFilters: [isnotnull(day" in scanned(df) and df.count() == 10
    assert len(df.inputFiles()) >= 1


def test_empty_results_keep_the_schema(spark, folder):
    none = spark.read.parquet(folder).filter("id < 0")
    assert none.count() == 0 and none.schema == spark.read.parquet(folder).schema


def test_a_further_table_shows_in_the_catalog(spark, tmp_path):
    from tidewater.plans import QUERIES, load_all

    load_all()
    for name in ("orders", "invoices"):
        pq.write_table(pa.table({"a": [1, 2]}), tmp_path / f"{name}.parquet")
    rows = QUERIES["catalog_browse"](spark, str(tmp_path)).collect()
    assert {(r["name"], r["n_rows"]) for r in rows} == {("orders", 2), ("invoices", 2)}


def test_browse_and_names(spark, sf_dir, tmp_path):
    names = {r["name"] for r in browse(spark, sf_dir).collect()}
    assert {"orders", "lineitem", "conversations"} <= names
    assert all(r["is_leaf"] for r in browse(spark, sf_dir).collect())
    assert named_table(spark, ["nation"], sf_dir).count() == 25
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "only.parquet")
    assert named_table(spark, None, str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="name is needed"):
        named_table(spark, [], sf_dir)


def test_browse_catalog(spark):
    spark.range(1).createOrReplaceTempView("numbers_view")
    assert ("default", False) in {(r["name"], r["is_leaf"]) for r in browse_catalog(spark).collect()}
    assert ("numbers_view", True) in {(r["name"], r["is_leaf"]) for r in browse_catalog(spark, "default").collect()}


def test_native_query_and_dry_run(spark):
    df = spark.range(10)
    assert native_query(spark, "SELECT * FROM numbers WHERE id > :low", {"numbers": df}, {"low": 6}).count() == 3
    assert dry_run(spark, "SELECT id + 1 AS x FROM numbers", {"numbers": df}).names == ["x"]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        dry_run(spark, "SELECT nothing FROM numbers", {"numbers": df})


def test_hidden_columns_and_schema_rows(spark):
    df = spark.createDataFrame(
        [], "id bigint, secret string, employee struct<first_name string, last_name string, age bigint>, departments array<string>, turns array<struct<t:int>>"
    )
    marked = with_display_name(hide(df, "secret"), "id", "Identifier")
    assert select_star(marked).columns == ["id", "employee", "departments", "turns"]
    assert marked.filter("secret = 'x'").columns == df.columns
    rows = [(r["pos"], r["path"], r["type"], r["visibility"]) for r in schema_rows(marked).orderBy("pos").collect()]
    assert rows[1] == (1, "secret", "string", "HIDDEN")
    assert [p for _, p, _, _ in rows] == [
        "id", "secret", "employee", "employee.first_name", "employee.last_name", "employee.age", "departments", "turns", "turns[].t",
    ]
    assert marked.schema["id"].metadata["display_name"] == "Identifier"


def test_reserved_names():
    check_names(StructType.fromDDL("_PARTITIONDATE date, a int, __b int"))
    with pytest.raises(ValueError, match="underscore"):
        check_names(StructType.fromDDL("_x int"))


def test_generated_rows(spark):
    keys = spark.range(200)
    layout = {"first_name": "string", "age": "bigint"}
    a = generate_rows(keys, "id", layout, seed=1)
    assert rows_of(a) == rows_of(generate_rows(keys.repartition(7), "id", layout, seed=1))
    assert rows_of(a) != rows_of(generate_rows(keys, "id", layout, seed=2))
    bad = a.filter(~F.col("first_name").rlike("^[a-z]{10}$") | ~F.col("age").between(0, 99))
    assert bad.count() == 0


def test_layout_is_written_once_and_again_when_the_table_changes(spark):
    from tidewater.session import scratch_path
    from tidewater.sources.layouts import partitioned

    path = scratch_path(spark, "laid-out")
    write = lambda n: spark.range(n).selectExpr("id", "id % 3 AS k").write.mode("overwrite").parquet(path)
    by = {"part": F.col("k") * 10}
    files = lambda: sorted(partitioned(spark, path, by).inputFiles())
    write(30)
    first = files()
    assert files() == first  # found, not written again
    assert partitioned(spark, path, by).count() == 30
    assert files() != sorted(partitioned(spark, path, {"part": F.col("k")}).inputFiles())
    scan = partitioned(spark, path, by).filter("part = 20")
    assert scan.count() == 10 and "PartitionFilters: [isnotnull(part" in scan._jdf.queryExecution().executedPlan().toString()
    write(60)
    assert not set(files()) & set(first) and partitioned(spark, path, by).count() == 60


def test_queries_share_one_layout(spark, sf_dir):
    from tidewater.plans.scans import _events_by_day

    first = sorted(_events_by_day(spark, sf_dir).inputFiles())
    import __spark_entry__ as entry

    entry.queries()["scan_partition_pruning"](spark, sf_dir).collect()
    assert sorted(_events_by_day(spark, sf_dir).inputFiles()) == first
