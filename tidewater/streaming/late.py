"""Time buckets that close, and a table of the rows that came too late for theirs.

A watermark alone forgets rows for closed buckets. Here a stateful operator keeps
the totals of open buckets only: a bucket closes once a row ``lateness`` newer
than its end has been seen, its state goes, and any row that still arrives for it
is sent to the rejects. Totals and rejects together are every row once, so a
batch job can add the rejects at any time (``merged``).

A micro-batch writes what it changed to a folder of its own; one that is retried
after a failure overwrites it, so nothing counts twice.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewater.session import scratch_path, ship

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGES = "kind string, bucket bigint, key string, n bigint, units bigint, at bigint"
MICROS = 1_000_000


class Buckets(StatefulProcessor):
    """One open bucket of one key: number of rows and sum of units, until the watermark passes its end."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n bigint, units bigint")

    def handleInputRows(self, key, rows, timerValues):
        bucket, name = key
        ends_ms = (bucket + self.width) // 1000
        if timerValues.getCurrentWatermarkInMs() >= ends_ms:
            for row in rows:
                yield Row(kind="late", bucket=bucket, key=name, n=1, units=row["units"], at=row["at"])
            return
        if self.totals.exists():
            n, units = self.totals.get()
        else:
            n, units = 0, 0
            self.handle.registerTimer(ends_ms)
        for row in rows:
            n, units = n + 1, units + (row["units"] or 0)
        self.totals.update((n, units))
        yield Row(kind="total", bucket=bucket, key=name, n=n, units=units, at=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.totals.clear()
        return iter([])

    def close(self) -> None:
        pass


def bucket_changes(rows: DataFrame, ts: str, key: str, units: str, width_seconds: int, lateness: str) -> DataFrame:
    """Streaming frame of changes: ``total`` rows (the newest of a bucket and key counts) and ``late`` rows.

    ``units`` is a whole number to add up; NULL adds nothing, and NULL keys are
    a key. Rows without a time have no bucket and are left out.
    """
    width = width_seconds * MICROS
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness).filter("_ts IS NOT NULL")
    # As a number the time carries no watermark, so Spark hands late rows on.
    at = F.unix_micros("_ts")
    placed = timed.select(
        (F.floor(at / F.lit(width)) * width).cast("bigint").alias("bucket"),
        F.col(key).cast("string").alias("key"),
        F.col(units).cast("bigint").alias("units"),
        at.alias("at"),
    )
    return placed.groupBy("bucket", "key").transformWithState(Buckets(width), CHANGES, "Update", "EventTime")


def run_with_rejects(changes: DataFrame, label: str = "late-buckets"):
    """Process all files there are: (totals, rejects, progress of the batches).

    ``totals`` has bucket, key, n and units; ``rejects`` also the time of each row.
    """
    spark: SparkSession = changes.sparkSession
    ship(spark)
    base = scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/out/b{batch_id}")

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        run = (
            changes.writeStream.outputMode("update")
            .option("checkpointLocation", f"{base}/state")
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    written = spark.read.schema(StructType([*changes.schema.fields, StructField("batch", IntegerType())])).parquet(f"{base}/out/*")
    newest = F.max_by(F.struct("n", "units"), "batch").alias("v")
    totals = written.filter("kind = 'total'").groupBy("bucket", "key").agg(newest).select("bucket", "key", "v.*")
    return totals, written.filter("kind = 'late'").select("bucket", "key", "units", "at"), run.recentProgress


def merged(totals: DataFrame, rejects: DataFrame) -> DataFrame:
    """Totals with the rejected rows added: bucket (a time), key, n, units."""
    late = rejects.select("bucket", "key", F.lit(1).cast("bigint").alias("n"), "units")
    both = totals.unionByName(late).groupBy("bucket", "key").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
    return both.withColumn("bucket", F.timestamp_micros("bucket").cast("timestamp_ntz"))
