"""Value conversion: accepted pairs, rejected pairs, nested fill, rejects."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.functions.conform import (
    ACCEPTS,
    SchemaMismatch,
    conform,
    conform_checked,
    good_rows,
    reject_rows,
)

NUMERIC, BIG = "decimal(38,9)", "decimal(38,18)"


def one(spark, value_sql, declared):
    df = spark.sql(f"SELECT {value_sql} AS x")
    out = conform(df, f"x {declared}")
    assert out.schema["x"].dataType.simpleString() == declared
    return out.first()["x"]


@pytest.mark.parametrize(
    "value,declared,want",
    [
        ("CAST('56.234' AS DECIMAL(20,10))", NUMERIC, Decimal("56.234000000")),
        ("CAST('56.0123456789' AS DECIMAL(20,10))", NUMERIC, Decimal("56.012345679")),
        ("CAST('-56.0123456785' AS DECIMAL(20,10))", NUMERIC, Decimal("-56.012345679")),
        ("'123.456'", NUMERIC, Decimal("123.456000000")),
        ("20", NUMERIC, Decimal("20.000000000")),
        ("45678L", NUMERIC, Decimal("45678.000000000")),
        ("7.142857142857D", NUMERIC, Decimal("7.142857143")),
        ("'123.456'", BIG, Decimal("123.456").quantize(Decimal("1e-18"))),
        ("'17'", "int", 17),
        ("'-9000000000'", "bigint", -9000000000),
        ("'2.5'", "double", 2.5),
        ("'true'", "boolean", True),
        ("12", "bigint", 12),
        ("12", "string", "12"),
        ("12L", "string", "12"),
        ("true", "string", "true"),
        ("1.5D", "string", "1.5"),
        ("CAST(1.5 AS FLOAT)", "double", 1.5),
        ("CAST('0.000000001' AS DECIMAL(38,9))", "string", "0.000000001"),
        ("DATE'1970-01-02'", "date", dt.date(1970, 1, 2)),
        ("DATE'1969-12-30'", "string", "1969-12-30"),
        ("TIMESTAMP_NTZ'2023-02-02 07:08:09'", "string", "2023-02-02T07:08:09"),
        ("TIMESTAMP_NTZ'2023-02-02 07:08:09.120'", "string", "2023-02-02T07:08:09.12"),
        ("TIMESTAMP'2023-02-02 07:08:09+06:00'", "string", "2023-02-02T01:08:09Z"),
        ("TIMESTAMP'2023-02-02 07:08:09+05:30'", "timestamp_ntz", dt.datetime(2023, 2, 2, 1, 38, 9)),
        ("X'0102'", "binary", bytearray(b"\x01\x02")),
        ("CAST(NULL AS STRING)", "int", None),
        ("NULL", "double", None),
        ("array(1, 2, 3)", "array<bigint>", [1, 2, 3]),
    ],
)
def test_accepted(spark, value, declared, want):
    assert one(spark, value, declared) == want


@pytest.mark.parametrize(
    "value,declared",
    [
        ("X'01'", "string"),
        ("12", "double"),
        ("12", "float"),
        ("12L", "int"),
        ("1.5D", "float"),
        ("1.5D", "int"),
        ("true", "int"),
        ("DATE'2024-01-01'", "timestamp"),
        ("'2024-01-01'", "date"),
        ("CAST(1 AS DECIMAL(9,2))", "double"),
        ("1", "array<int>"),
        ("array(1)", "int"),
        ("named_struct('a', 1)", "string"),
    ],
)
def test_rejected_pairs_fail_before_any_row_is_read(spark, value, declared):
    with pytest.raises(SchemaMismatch):
        conform(spark.sql(f"SELECT {value} AS x"), f"x {declared}")


def test_table_of_pairs_is_closed():
    for source, targets in ACCEPTS.items():
        if source != "void":
            assert source in targets


@pytest.mark.parametrize("declared", ["int", "bigint", "double", NUMERIC])
def test_bad_text_fails_strictly(spark, declared):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "'not a number'", declared)


def test_nested_struct_is_filled_in_declared_order(spark):
    df = spark.sql("SELECT named_struct('flags', array(true, false), 'i', 1, 's', 2) AS r")
    out = conform(df, "r struct<i: int, s: string, d: date, flags: array<boolean>>", fill=True)
    assert out.first()["r"].asDict() == {"i": 1, "s": "2", "d": None, "flags": [True, False]}
    with pytest.raises(SchemaMismatch, match="long"):
        conform(spark.sql("SELECT named_struct('i', 1, 'long', 2) AS r"), "r struct<i: int, s: string>")


def test_missing_and_extra_fields(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert conform(df, "c date, b string, a bigint", fill=True).columns == ["c", "b", "a"]
    with pytest.raises(SchemaMismatch, match="missing"):
        conform(df, "a int, b string, c date")
    with pytest.raises(SchemaMismatch, match="not declared"):
        conform(df, "a int", fill=True)


def test_rejects_and_good_rows(spark):
    df = spark.createDataFrame([("1", "2.5", "a"), ("x", "y", "b"), (None, "1", "c"), ("3", "1e", "d")], "i string, f string, k string")
    checked = conform_checked(df, "k string, i int, f double")
    assert sorted(r["k"] for r in good_rows(checked).collect()) == ["a", "c"]
    rejects = sorted(tuple(r) for r in reject_rows(checked, ["k"]).collect())
    assert rejects == [("b", "f", "y"), ("b", "i", "x"), ("d", "f", "1e")]


def test_bad_elements_inside_nested_values_are_rejected(spark):
    df = spark.sql(
        "SELECT 1 AS k, array('1', 'x') AS a, named_struct('n', '2') AS s UNION ALL "
        "SELECT 2, array('1', NULL), named_struct('n', 'y') UNION ALL SELECT 3, array('7'), named_struct('n', CAST(NULL AS STRING))"
    )
    checked = conform_checked(df, "k int, a array<int>, s struct<n: int>")
    assert [r["k"] for r in good_rows(checked).collect()] == [3]
    assert sorted((r["k"], r["column"]) for r in reject_rows(checked, ["k"]).collect()) == [(1, "a"), (2, "s")]


def test_strict_and_checked_agree_when_nothing_is_bad(spark, sf_dir):
    text = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    declared = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    strict, checked = conform(text, declared), conform_checked(text, declared)
    assert sorted(strict.collect()) == sorted(good_rows(checked).collect())
    assert reject_rows(checked, ["s_suppkey"]).count() == 0


def test_text_with_a_pattern(spark):
    df = spark.createDataFrame([("01/02/2024",), ("31/31/2024",)], "d string")
    checked = conform_checked(df, "d date", formats={"d": "dd/MM/yyyy"})
    assert [r["d"] for r in good_rows(checked).collect()] == [dt.date(2024, 2, 1)]
    assert [r["raw"] for r in reject_rows(checked, []).collect()] == ["31/31/2024"]
