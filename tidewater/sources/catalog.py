"""Names, schemas and hidden columns."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

VISIBILITY = "visibility"
DISPLAY_NAME = "display_name"


def browse_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Children of the session catalog: its databases, or the tables of one database."""
    if database is None:
        found = spark.sql("SHOW DATABASES").select(F.lit("").alias("parent"), F.col("namespace").alias("name"), F.lit(False).alias("is_leaf"))
    else:
        found = spark.sql(f"SHOW TABLES IN `{database}`").select(
            F.lit(database).alias("parent"), F.col("tableName").alias("name"), F.lit(True).alias("is_leaf")
        )
    return found.select("parent", "name", _label("name").alias("display_name"), "is_leaf")


def _label(name: str) -> Column:
    return F.initcap(F.translate(name, "_", " "))


def browse(spark: SparkSession, root: str) -> DataFrame:
    """Children of a folder of parquet tables: (parent, name, display_name, is_leaf).

    The listing is a Spark scan of file names; file contents are not read. A
    table stored as a folder of part files shows as one child.
    """
    base = root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select("path")
    )
    after = F.substring_index(F.col("path"), base.split("://")[-1] + "/", -1)
    child = F.split_part(after, F.lit("/"), F.lit(1))
    return files.select(
        F.lit(base.rsplit("/", 1)[-1]).alias("parent"),
        F.regexp_replace(child, r"\.parquet$", "").alias("name"),
    ).distinct().select(
        "parent",
        "name",
        _label("name").alias("display_name"),
        F.lit(True).alias("is_leaf"),
    )


def named_table(spark: SparkSession, parts: list[str] | None, root: str | None = None) -> DataFrame:
    """Table by name parts, from the session catalog or below ``root``.

    A root that holds one table needs no name.
    """
    if root is None:
        return spark.table(".".join(f"`{p}`" for p in parts))
    if not parts:
        names = [r["name"] for r in browse(spark, root).select("name").limit(2).collect()]
        if len(names) != 1:
            raise ValueError("a table name is needed: the source holds more than one table")
        parts = names
    return spark.table(f"parquet.`{root.rstrip('/')}/{'/'.join(parts)}.parquet`")


def native_query(spark: SparkSession, text: str, tables: dict[str, DataFrame], args: dict | None = None) -> DataFrame:
    """Run source text as it stands over the named tables; ``args`` fill ``:name`` markers."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or {})


def dry_run(spark: SparkSession, text: str, tables: dict[str, DataFrame], args: dict | None = None) -> StructType:
    """Check a query and give its result schema without running it."""
    return native_query(spark, text, tables, args).schema


def _walk(fields: list[StructField], prefix: str = ""):
    for f in fields:
        path = f"{prefix}{f.name}"
        yield path, f
        inner = f.dataType
        suffix = "."
        while isinstance(inner, (ArrayType, MapType)):
            suffix = "[]" + suffix
            inner = inner.elementType if isinstance(inner, ArrayType) else inner.valueType
        if isinstance(inner, StructType):
            yield from _walk(inner.fields, path + suffix)


def schema_rows(df: DataFrame) -> DataFrame:
    """Schema as rows (pos, path, type, nullable, visibility), nested fields flattened."""
    rows = [
        (i, path, f.dataType.simpleString(), f.nullable, (f.metadata or {}).get(VISIBILITY, "REGULAR"))
        for i, (path, f) in enumerate(_walk(df.schema.fields))
    ]
    return df.sparkSession.createDataFrame(
        rows, "pos int, path string, type string, nullable boolean, visibility string"
    )


def hide(df: DataFrame, *names: str) -> DataFrame:
    """Mark columns hidden: left out of ``select_star`` but still addressable."""
    for name in names:
        df = df.withMetadata(name, {**(df.schema[name].metadata or {}), VISIBILITY: "HIDDEN"})
    return df


def select_star(df: DataFrame) -> DataFrame:
    """All columns that are not hidden."""
    return df.select(
        *[F.col(f.name) for f in df.schema.fields if (f.metadata or {}).get(VISIBILITY) != "HIDDEN"]
    )


def with_display_name(df: DataFrame, name: str, label: str) -> DataFrame:
    return df.withMetadata(name, {**(df.schema[name].metadata or {}), DISPLAY_NAME: label})


def check_names(schema: StructType) -> None:
    """Names may not start with one underscore, except the two reserved ones."""
    for f in schema.fields:
        one_underscore = f.name.startswith("_") and not f.name.startswith("__")
        if one_underscore and f.name not in ("_PARTITIONDATE", "_PARTITIONKEY"):
            raise ValueError(f"column name {f.name!r} must not start with a single underscore")
