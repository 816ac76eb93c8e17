"""Run a registered query and its checking SQL side by side and compare.

``python tests/oracle.py [sf_dir] [key or prefix ...]`` prints one line per key.
"""
from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import re
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Spark type name -> DuckDB type name, for the plain types queries return.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value if value is None else str(value)


def compare(df, con, sql: str) -> list[str]:
    """Problems found, empty when names, types and rows all agree."""
    problems = []
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]).upper() for d in cur.description}
    expected = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        want = TYPE_NAMES.get(kind, kind.upper())
        if want != types[field.name]:
            problems.append(f"type of {field.name}: {kind} != {types[field.name]}")
    order = sorted(names)
    rows = [tuple(plain(r[c]) for c in order) for r in df.collect()]
    at = [names.index(c) for c in order]
    wanted = [tuple(plain(r[i]) for i in at) for r in expected]
    if len(rows) != len(wanted):
        problems.append(f"rows {len(rows)} != {len(wanted)}")
    key = lambda r: tuple((v is None, v or "") for v in r)
    rows.sort(key=key)
    wanted.sort(key=key)
    if rows != wanted:
        bad = [(a, b) for a, b in zip(rows, wanted) if a != b]
        problems.append(f"{len(bad)} rows differ, e.g. {order} spark={bad[:2] and bad[0][0]} sql={bad[:2] and bad[0][1]}")
    return problems


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    oracle = entry.oracle_sql()
    failed = []
    for key, fn in entry.queries().items():
        if wanted and not any(re.fullmatch(w, key) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in oracle:
                problems = compare(df, con, oracle[key])
                note = "ok"
            else:
                problems, note = [], f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next key
            text = str(error).strip().split("JVM stacktrace")[0]
            problems = [f"{type(error).__name__}: {text[:600]}"]
            if "-v" in os.environ.get("CHECK", ""):
                traceback.print_exc()
        took = time.time() - start
        if problems:
            failed.append(key)
            print(f"FAIL {key} {took:.1f}s", *[f"   {p[:900]}" for p in problems], sep="\n", flush=True)
        else:
            print(f"{note:12} {key} {took:.1f}s", flush=True)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
