"""Partitioned layouts of a table that are written once and read by every query after that."""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession

from tidewater.session import scratch_path, shared_dir


def _files(spark: SparkSession, path: str) -> list[str]:
    """Name, length and time of change of the files of a table."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    out, todo = [], list(found or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += list(status.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(status.getPath()))
        else:
            out.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
    return sorted(out)


def partitioned(spark: SparkSession, path: str, by: dict[str, Column]) -> DataFrame:
    """The parquet table at ``path`` with the columns ``by``, laid out in folders by their values.

    The layout lies in the shared folder under a name made of the table's files
    and the partition expressions. The first call writes it, later ones find it;
    a changed table gets a new one. It appears at its place by one rename, so a
    failed or a second writer leaves nothing half done there. Few files per
    folder, but a busy one is split by size over as many tasks as it needs.
    """
    given = spark.read.parquet(path).withColumns(by)
    key = "\n".join([*_files(spark, path), *[f"{n}={c}" for n, c in by.items()]])
    folder = f"{shared_dir(spark)}/tidewater-{spark.sparkContext.applicationId}"
    final = f"{folder}/layout-{hashlib.sha256(key.encode()).hexdigest()[:32]}"
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = to_path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(to_path(final)):
        draft = scratch_path(spark, "layout")
        given.hint("rebalance", *by).write.partitionBy(*by).parquet(draft)
        if not system.rename(to_path(draft), to_path(final)) and not system.exists(to_path(final)):
            raise OSError(f"cannot move the layout to {final}")
    return spark.read.schema(given.schema).parquet(final)
