"""Time-bucket counts over arriving files."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewater.session import scratch_path


def bucket_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    ts: str,
    width: str,
    lateness: str | None,
    keys: list[str],
    aggregates: list[Column],
    name_glob: str = "*.parquet",
) -> DataFrame:
    """Streaming frame of tumbling-bucket aggregates.

    Without ``lateness`` every row counts, however late, and the state holds one
    row per bucket and key. With it, a bucket closes once a row ``lateness``
    newer than its end has arrived and rows for closed buckets are ignored, as
    the price of forgetting closed buckets.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name_glob)
        .option("maxFilesPerTrigger", 1000)
        .parquet(path)
    )
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    if lateness is not None:
        timed = timed.withWatermark(ts, lateness)
    return timed.groupBy(F.window(ts, width), *keys).agg(*aggregates)


def run_available(buckets: DataFrame, keys: list[str], label: str = "buckets") -> DataFrame:
    """Process all files there are, then stop, and return one row per bucket.

    Update mode lets closed buckets leave the state. Each micro-batch writes the
    buckets it changed into a folder of its own, and the newest version of a
    bucket wins on reading; a retried batch overwrites its own folder, so a
    restart counts nothing twice.
    """
    spark = buckets.sparkSession
    base = scratch_path(spark, label)
    out, state = f"{base}/out", f"{base}/state"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b{batch_id}")

    run = (
        buckets.writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    written = spark.read.schema(StructType([*buckets.schema.fields, StructField("batch_id", IntegerType())])).parquet(f"{out}/*")
    values = [n for n in buckets.columns if n not in ("window", *keys)]
    newest = written.groupBy("window", *keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return newest.select(F.col("window.start").cast("timestamp_ntz").alias("bucket"), *keys, "v.*")
