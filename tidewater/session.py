"""Session settings, table loading and lineage cuts shared by all jobs."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the results depend on. Sizing (shuffle partitions, memory,
# file split size) is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timeType.enabled": "true",
}

_local_shared_dir: str | None = None
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for their Python workers to import."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    folder = tempfile.TemporaryDirectory()  # the driver serves the file from here until it ends
    with zipfile.ZipFile(file := os.path.join(folder.name, "tidewater.zip"), "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(file)
    _shipped[context.applicationId] = folder


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a folder of this machine.
    """
    global _local_shared_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_shared_dir is None:
        _local_shared_dir = tempfile.mkdtemp(prefix="tidewater-")
    return _local_shared_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before.

    All paths of one application lie under one folder, which can be deleted once
    the application has ended.
    """
    return f"{shared_dir(spark)}/tidewater-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder; call it once results are written."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidewater-{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    The copy outlives lost executors, is computed once however often it is
    used, and gives the optimiser real sizes to choose join strategies by.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
