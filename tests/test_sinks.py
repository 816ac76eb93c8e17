"""Page packing, exports and read statistics."""
import random

import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sources.sinks import (
    PAGE_BYTES,
    export_files,
    export_pages,
    observed_read,
    pack_pages,
    page_numbers,
    read_profile,
    time_reads,
)


def greedy(sizes, limit):
    out, filled, page = [], 0, 0
    for s in sizes:
        if filled >= limit:
            filled, page = 0, page + 1
        out.append(page)
        filled += s
    return out


@pytest.mark.parametrize(
    "sizes,pages",
    [
        ([63_000] * 4, [0, 0, 0, 0]),
        ([257_000, 100_000, 200_000, 200_000], [0, 1, 1, 2]),
        ([256_000, 1], [0, 1]),
        ([255_999, 1, 1], [0, 0, 1]),
        ([], []),
        ([0, 0, 0], [0, 0, 0]),
    ],
)
def test_page_numbers(sizes, pages):
    assert page_numbers(sizes)[0].tolist() == pages


def test_page_numbers_over_batches():
    rng = random.Random(1)
    sizes = [rng.choice([0, 1, 40, 99, 100, 250]) for _ in range(500)]
    got, carry, page, at = [], 0, 0, 0
    while at < len(sizes):
        step = rng.randint(1, 40)
        numbers, carry, page = page_numbers(sizes[at : at + step], 100, carry, page)
        got += numbers.tolist()
        at += step
    assert got == greedy(sizes, 100)


def test_pack_pages_per_stream(spark):
    rng = random.Random(4)
    data = [(i, i % 3, rng.randint(0, 90)) for i in range(900)]
    df = spark.createDataFrame(data, "id bigint, stream bigint, size bigint").repartition(6)
    packed = pack_pages(df, "stream", ["id"], size=F.col("size"), limit=200).collect()
    for s in range(3):
        mine = sorted((r["id"], r["size"], r["page_no"]) for r in packed if r["stream"] == s)
        assert [p for _, _, p in mine] == greedy([z for _, z, _ in mine], 200)


def test_export_pages_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "id bigint, stream bigint, body binary")
    path = scratch_path(spark, "empty-pages")
    out = export_pages(df, "stream", ["id"], path)
    assert out.count() == 0 and out.columns == ["id", "stream", "body", "row_bytes", "page_no"]
    assert spark.read.parquet(path).columns == out.columns


def test_page_limit_is_the_fixed_one():
    assert PAGE_BYTES == 256_000


@pytest.mark.parametrize("fmt,options", [("parquet", {}), ("json", {}), ("csv", {"header": "true"}), ("orc", {})])
def test_export_files(spark, sf_dir, fmt, options):
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    back = export_files(supplier, fmt, **options)
    assert sorted(back.collect()) == sorted(supplier.collect())


def test_read_profile_and_observation(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    profile = read_profile(orders).agg(F.sum("n_rows").alias("n"), F.sum("n_bytes").alias("b")).first()
    watched, seen = observed_read(orders)
    watched.write.format("noop").mode("overwrite").save()
    assert (seen.get["n_rows"], seen.get["n_bytes"]) == (profile["n"], profile["b"])
    assert profile["n"] == orders.count()


def test_time_reads(spark, sf_dir):
    rows = time_reads(spark.read.parquet(f"{sf_dir}/supplier.parquet")).collect()
    assert [r["run"] for r in rows] == [0, 1]
    assert len({(r["n_rows"], r["n_bytes"]) for r in rows}) == 1 and rows[0]["n_rows"] > 0
    assert all(r["seconds"] > 0 and r["bytes_per_second"] > 0 for r in rows)


def test_scratch_is_cleared(spark):
    from tidewater.session import clear_scratch, materialise

    kept = materialise(spark.range(3), "kept")
    path = kept.inputFiles()[0]
    assert kept.count() == 3
    clear_scratch(spark)
    import os

    assert not os.path.exists(path.removeprefix("file://"))


def test_profile_of_many_files(spark):
    """Rows and bytes by file, times within the task, and totals from the observation of the same pass."""
    from tidewater.session import scratch_path
    from tidewater.sources.sinks import profile_files

    path = scratch_path(spark, "profiled")
    spark.range(1000).selectExpr("id", "repeat('x', cast(id % 7 as int)) AS s", "id % 5 AS p").repartition(5, "p").write.parquet(path)
    table = spark.read.parquet(path)
    profile, seen = profile_files(table)
    rows = profile.collect()
    want = {
        r["f"]: (r["n"], r["b"])
        for r in table.groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(16 + F.length("s")).alias("b"))
        .collect()
    }
    got = {}
    for r in rows:
        n, b = got.get(r["file"], (0, 0))
        got[r["file"]] = (n + r["n_rows"], b + r["n_bytes"])
        assert 0 < r["first_seconds"] <= r["seconds"] and r["file_bytes"] > 0
        assert r["bytes_per_second"] == r["n_bytes"] / r["seconds"]
    assert got == want
    assert seen["n_rows"] == 1000 and seen["n_bytes"] == sum(b for _, b in want.values())
