"""Writers: byte-bounded pages, file exports, read statistics."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidewater.session import materialise, scratch_path

# Fixed value: a page closes after the row that brings it to this many bytes.
PAGE_BYTES = 256_000

_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: text and binary by length, other values by their width."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"))
        else:
            width = _WIDTH.get(f.dataType.simpleString(), 8)
            parts.append(F.when(c.isNull(), F.lit(0)).otherwise(F.lit(width)).cast("bigint"))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def page_numbers(sizes, limit: int = PAGE_BYTES, carry: int = 0, page: int = 0):
    """Greedy page number of each row: a page closes after the row that reaches ``limit``.

    ``carry`` and ``page`` are the bytes already in the open page and its
    number. Returns (numbers, bytes in the open page, its number). Works page by
    page on the running total, not row by row.
    """
    import numpy as np

    sizes = np.asarray(sizes, dtype="int64")
    ends = np.cumsum(sizes)
    out = np.empty(len(sizes), dtype="int32")
    start, base = 0, -carry
    while start < len(sizes):
        close = int(np.searchsorted(ends, base + limit, side="left"))
        close = max(close, start)
        if close >= len(sizes):
            out[start:] = page
            return out, int(ends[-1]) - base, page
        out[start : close + 1] = page
        start, base, page = close + 1, int(ends[close]), page + 1
    return out, 0, page


def pack_pages(
    df: DataFrame, stream: str, order: Sequence[str], size: Column | None = None, limit: int = PAGE_BYTES
) -> DataFrame:
    """Add ``page_no`` to every row: pages fill in ``order`` within each stream.

    Packing is sequential inside a stream, so streams should be bounded slices
    of the data (for example ranges of the key). Rows pass once through Arrow,
    sorted; no stream is held in memory.
    """
    sized = df.withColumn("row_bytes", size if size is not None else row_bytes(df))
    arranged = sized.repartition(stream).sortWithinPartitions(stream, *order)
    schema = StructType([*sized.schema.fields, StructField("page_no", IntegerType(), False)])

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        begun, current, carry, page = False, None, 0, 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(stream))
            sizes = batch.column(batch.schema.get_field_index("row_bytes")).to_numpy(zero_copy_only=False)
            labels = keys.to_numpy(zero_copy_only=False)
            numbers = np.empty(len(labels), dtype="int32")
            cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if not begun or labels[a] != current:
                    begun, current, carry, page = True, labels[a], 0, 0
                numbers[a:b], carry, page = page_numbers(sizes[a:b], limit, carry, page)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(numbers, pa.int32())], [*batch.schema.names, "page_no"]
            )

    return arranged.mapInArrow(pack, schema)


def export_pages(df: DataFrame, stream: str, order: Sequence[str], path: str) -> DataFrame:
    """Write paged rows to ``path`` and return them as read back.

    An empty input still writes one file that holds the schema.
    """
    paged = pack_pages(df, stream, order)
    paged.write.parquet(path)
    return df.sparkSession.read.schema(paged.schema).parquet(path)


def export_files(df: DataFrame, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Save a result as parquet, json or csv and read it back with the same schema."""
    path = path or scratch_path(df.sparkSession, f"export-{fmt}")
    df.write.format(fmt).options(**options).save(path)
    return df.sparkSession.read.format(fmt).options(**options).schema(df.schema).load(path)


def read_profile(df: DataFrame, slot: Column | None = None) -> DataFrame:
    """Rows and payload bytes per slot, by default per input partition."""
    return (
        df.select((slot if slot is not None else F.spark_partition_id()).alias("slot"), row_bytes(df).alias("b"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("b").cast(LongType()).alias("n_bytes"))
    )


def observed_read(df: DataFrame, name: str = "read"):
    """(df, observation): rows and bytes are counted while the frame is being used."""
    from pyspark.sql import Observation

    seen = Observation(name)
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.sum(row_bytes(df)).alias("n_bytes")
    )
    return watched, seen


def profile_files(df: DataFrame):
    """Read everything once: a row per input file and task, and what the whole read was observed to hold.

    Columns: file, split (task), n_rows, n_bytes (payload), file_bytes, first_seconds (from the start of
    the task to its first rows of the file), seconds (to the last ones) and bytes_per_second. ``df`` must be
    a plain read of files. The totals come from an observation of the same pass, so they hold the rows of
    every file, also of those no row of which came through.
    """
    watched, seen = observed_read(df, "files")
    rows = watched.select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("file_bytes"),
        row_bytes(df).alias("b"),
        F.spark_partition_id().alias("split"),
    )

    def clock(batches):
        import time

        import pyarrow as pa

        start, files = time.perf_counter(), {}
        for batch in batches:
            now = time.perf_counter() - start
            held = pa.Table.from_batches([batch]).group_by(["file", "file_bytes", "split"]).aggregate([("b", "sum"), ("b", "count")])
            for r in held.to_pylist():
                n_rows, n_bytes, first, _ = files.get((r["file"], r["file_bytes"], r["split"]), (0, 0, now, now))
                files[r["file"], r["file_bytes"], r["split"]] = (n_rows + r["b_count"], n_bytes + r["b_sum"], first, now)
        if files:
            names = ["file", "file_bytes", "split", "n_rows", "n_bytes", "first_seconds", "seconds"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = zip(*[(*key, *value) for key, value in files.items()])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "file string, file_bytes bigint, split int, n_rows bigint, n_bytes bigint, first_seconds double, seconds double"
    found = materialise(rows.mapInArrow(clock, schema), "profile")
    return found.withColumn("bytes_per_second", F.col("n_bytes") / F.col("seconds")), seen.get


def time_reads(df: DataFrame, runs: int = 2) -> DataFrame:
    """Read everything ``runs`` times: first-row latency, rows, bytes, seconds and throughput of each run.

    Rows go to the noop sink; counts are taken on the way by the executors.
    """
    import time

    rows = []
    for run in range(runs):
        start = time.perf_counter()
        df.limit(1).collect()
        first = time.perf_counter() - start
        watched, seen = observed_read(df, f"read-{run}")
        start = time.perf_counter()
        watched.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        n_bytes = int(seen.get["n_bytes"] or 0)
        rows.append((run, first, int(seen.get["n_rows"]), n_bytes, took, n_bytes / took))
    return df.sparkSession.createDataFrame(
        rows, "run int, first_row_seconds double, n_rows bigint, n_bytes bigint, seconds double, bytes_per_second double"
    )
