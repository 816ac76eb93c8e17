"""Streaming queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.numeric import fixed
from tidewater.plans.registry import query
from tidewater.session import scratch_path, table
from tidewater.streaming.buckets import bucket_stream, run_available
from tidewater.streaming.late import bucket_changes, merged, run_with_rejects


@query(
    "stream_bucket",
    "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, event_type, count(*) AS n, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM events GROUP BY ALL",
)
def stream_bucket(spark, sf_dir):
    """Six-hour counts over the event files as they arrive; equals the batch buckets."""
    buckets = bucket_stream(
        spark,
        sf_dir,
        table(spark, sf_dir, "events").schema,
        ts="ts",
        width="6 hours",
        lateness=None,
        keys=["event_type"],
        aggregates=[F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")],
        name_glob="events*.parquet",
    )
    return run_available(buckets, ["event_type"])


@query(
    "stream_late_rows",
    "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, event_type, count(*) AS n, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM events GROUP BY ALL",
)
def stream_late_rows(spark, sf_dir):
    """Six-hour totals of events that arrive out of order: closed buckets, with the rows that came too late added."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", fixed(F.col("value")).alias("units"))
    path = scratch_path(spark, "arrivals")
    events.repartition(24, F.xxhash64("ts", "units")).write.parquet(path)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(path)
    totals, rejects, _ = run_with_rejects(bucket_changes(arriving, "ts", "event_type", "units", 6 * 3600, "1 day"))
    whole = merged(totals, rejects)
    return whole.select(
        "bucket", F.col("key").alias("event_type"), "n", (F.col("units").cast("decimal(26,0)") / 100).cast("decimal(28,2)").alias("total")
    )
