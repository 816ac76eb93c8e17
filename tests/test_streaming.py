"""Streams over arriving files against the batch answer."""
import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path, table
from tidewater.streaming.buckets import bucket_stream, run_available
from tidewater.streaming.late import bucket_changes, merged, run_with_rejects


@pytest.mark.parametrize("files_per_day", [1, 4])
def test_stream_equals_batch_over_many_files(spark, sf_dir, files_per_day):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "arrivals")
    for day in range(1, 31, 6):
        part = events.filter(F.dayofmonth("ts").between(day, day + 5))
        part.repartition(files_per_day).write.mode("append").parquet(path)
    stream = bucket_stream(
        spark, path, events.schema, "ts", "1 hour", "40 days", ["event_type"], [F.count(F.lit(1)).alias("n"), F.max("value").alias("m")]
    )
    got = run_available(stream, ["event_type"])
    want = events.groupBy(F.window("ts", "1 hour")["start"].alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("m")
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rows_behind_the_watermark_are_left_out(spark):
    path = scratch_path(spark, "late")
    rows = lambda *stamps: spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    rows("2024-01-01 00:10:00", "2024-01-05 00:00:00").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = bucket_stream(spark, path, schema, "ts", "1 hour", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    got = sorted((str(r["bucket"]), r["n"]) for r in run_available(stream, []).collect())
    assert got == [("2024-01-01 00:00:00", 1), ("2024-01-05 00:00:00", 1)]


def test_no_row_is_lost_over_many_unordered_files(spark):
    """2,001 files in three batches, the last file holding the oldest row."""
    path = scratch_path(spark, "many")
    rows = spark.range(2001).select((F.lit(4000) - F.col("id")).alias("minute"))
    rows.select(F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz").alias("ts")).repartition(2001, "ts").write.option(
        "maxRecordsPerFile", 1
    ).parquet(path)
    schema = spark.read.parquet(path).schema
    stream = bucket_stream(spark, path, schema, "ts", "1 hour", None, [], [F.count(F.lit(1)).alias("n")])
    assert run_available(stream, []).agg(F.sum("n")).first()[0] == 2001


def _arrivals(spark, batches, path):
    """One file per list of (minute, key, units), in that order of arrival."""
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "minute long, key string, units long")
        stamped = df.select(F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz").alias("ts"), "key", "units")
        stamped.coalesce(1).write.parquet(f"{path}/part={k}")


def _run_late(spark, path, files, width=3600, lateness="2 hours"):
    schema = "ts timestamp_ntz, key string, units long, part int"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return run_with_rejects(bucket_changes(rows, "ts", "key", "units", width, lateness))


def test_closed_buckets_send_their_late_rows_to_the_rejects(spark):
    path = scratch_path(spark, "closing")
    batches = [[(10, "a", 1), (20, "a", 2), (30, None, 4)], [(600, "a", 8)], [(15, "a", 16), (601, "a", None)], [(16, "b", 32)]]
    _arrivals(spark, batches, path)
    totals, rejects, progress = _run_late(spark, path, 1)
    hour = 3600 * 1_000_000
    got = {(r["bucket"] // hour, r["key"]): (r["n"], r["units"]) for r in totals.collect()}
    assert got == {(0, "a"): (2, 3), (0, None): (1, 4), (10, "a"): (2, 8)}
    late = sorted((r["bucket"], r["key"], r["units"], r["at"] // 60_000_000) for r in rejects.collect())
    assert late == [(0, "a", 16, 15), (0, "b", 32, 16)]
    whole = {(str(r["bucket"]), r["key"]): (r["n"], r["units"]) for r in merged(totals, rejects).collect()}
    assert whole[("1970-01-01 00:00:00", "a")] == (3, 19) and whole[("1970-01-01 00:00:00", "b")] == (1, 32)


def test_buckets_and_rejects_equal_the_batch_answer_and_state_is_bounded(spark):
    """2,001 files out of order; the oldest rows come last, and few buckets are ever open."""
    path = scratch_path(spark, "disorder")
    n = 2001
    order = (F.col("id") * 7919 % n).alias("minute")
    rows = spark.range(n).select(F.when(F.col("id") > n - 20, F.col("id") - (n - 20)).otherwise(F.col("id") * 30 + F.pmod(F.hash("id"), F.lit(240))).alias("minute"), "id")
    stamped = rows.select(F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz").alias("ts"), F.lit("k").alias("key"), F.col("id").alias("units"), "id")
    stamped.repartitionByRange(n, "id").drop("id").sortWithinPartitions("ts").write.option("maxRecordsPerFile", 1).parquet(path)
    schema = "ts timestamp_ntz, key string, units long"
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 400).parquet(path)
    totals, rejects, progress = run_with_rejects(bucket_changes(arriving, "ts", "key", "units", 3600, "2 hours"))
    want = stamped.groupBy(F.window("ts", "1 hour")["start"].alias("bucket"), "key").agg(F.count(F.lit(1)).alias("n"), F.sum("units").alias("units"))
    got = merged(totals, rejects)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert rejects.count() > 0
    # A batch of 400 files spans some 200 hours; without closing, the state would hold all 1,000.
    assert progress[-1].stateOperators[0].numRowsTotal < 800
