"""Conform rows to a declared schema: strict, filled, or with a reject table."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, StructType

# Which declared kinds accept which source kind.
# uint32 is kept as bigint and uint64 as decimal(20,0).
ACCEPTS = {
    "string": {"string", "int", "bigint", "float", "double", "boolean", "decimal"},
    "decimal": {"decimal", "string"},
    "boolean": {"boolean", "string"},
    "int": {"int", "bigint", "decimal", "string"},
    "bigint": {"bigint", "decimal", "string"},
    "float": {"float", "double", "decimal", "string"},
    "double": {"double", "decimal", "string"},
    "binary": {"binary"},
    "date": {"date", "string"},
    "timestamp_ntz": {"timestamp_ntz", "timestamp", "string"},
    "timestamp": {"timestamp", "timestamp_ntz", "string"},
    "void": {
        "string", "int", "bigint", "float", "double", "boolean", "decimal",
        "binary", "date", "timestamp_ntz", "timestamp", "array", "struct",
    },
}

NUMERIC = DecimalType(38, 9)
BIGNUMERIC = DecimalType(38, 18)


# A format for text in Spark's own date and timestamp layout, which parses fastest.
ISO = "iso"


class SchemaMismatch(ValueError):
    """The input cannot conform to the declared schema, whatever its rows hold."""


def kind_of(t: DataType) -> str:
    name = t.simpleString()
    for compound in ("decimal", "array", "struct", "map", "string"):
        if name.startswith(compound):
            return compound
    return name


def iso_text(ts: Column, zone: str = "") -> Column:
    """ISO text of a timestamp; the fraction shows only the digits it needs."""
    fraction = F.rtrim(F.date_format(ts, ".SSSSSS"), F.lit("0"))
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == ".", "").otherwise(fraction), F.lit(zone)
    )


def check_pair(path: str, source: DataType, declared: DataType) -> None:
    """Raise unless the conversion table lists (source, declared)."""
    have, want = kind_of(source), kind_of(declared)
    if isinstance(source, ArrayType) and isinstance(declared, ArrayType):
        check_pair(f"{path}[]", source.elementType, declared.elementType)
    elif isinstance(source, StructType) and isinstance(declared, StructType):
        check_struct(path, source, declared)
    elif want not in ACCEPTS.get(have, set()):
        raise SchemaMismatch(f"{path}: a value of type {have} does not go into a field of type {want}")


def check_struct(path: str, source: StructType, declared: StructType) -> None:
    extra = [n for n in source.names if n not in declared.names]
    if extra:
        raise SchemaMismatch(f"{path or 'row'}: fields {extra} are not declared")
    for field in declared.fields:
        if field.name in source.names:
            inner = f"{path}.{field.name}" if path else field.name
            check_pair(inner, source[field.name].dataType, field.dataType)


def convert(c: Column, source: DataType, declared: DataType, cast: str = "cast", fmt: str | None = None) -> Column:
    """Convert one value. ``cast`` is "cast" (a bad value fails) or "try_cast" (becomes NULL)."""
    if isinstance(source, ArrayType) and isinstance(declared, ArrayType):
        return F.transform(c, lambda e: convert(e, source.elementType, declared.elementType, cast))
    if isinstance(source, StructType) and isinstance(declared, StructType):
        parts = [
            (convert(c[f.name], source[f.name].dataType, f.dataType, cast) if f.name in source.names else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in declared.fields
        ]
        return F.when(c.isNotNull(), F.struct(*parts))
    have, want = kind_of(source), kind_of(declared)
    if fmt == ISO:
        return getattr(c, cast)(declared)
    if fmt is not None:
        strict = cast == "cast"
        if want == "date":
            return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)
        parsed = F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))
        return parsed.cast(declared)
    if want == "string" and have == "timestamp_ntz":
        return iso_text(c)
    if want == "string" and have == "timestamp":
        return iso_text(c, "Z")
    return getattr(c, cast)(declared)


def declared_schema(declared: StructType | str) -> StructType:
    """A schema, or its DDL text."""
    return StructType.fromDDL(declared) if isinstance(declared, str) else declared


def is_bad(c: Column, source: DataType, declared: DataType, fmt: str | None = None) -> Column:
    """Whether a value, or any value nested in it, is present but does not convert."""
    if isinstance(source, ArrayType) and isinstance(declared, ArrayType):
        inner = F.exists(c, lambda e: is_bad(e, source.elementType, declared.elementType))
        return c.isNotNull() & F.coalesce(inner, F.lit(False))
    if isinstance(source, StructType) and isinstance(declared, StructType):
        found = F.lit(False)
        for f in declared.fields:
            if f.name in source.names:
                found = found | is_bad(c[f.name], source[f.name].dataType, f.dataType)
        return c.isNotNull() & found
    return c.isNotNull() & convert(c, source, declared, "try_cast", fmt).isNull()


def conform(
    df: DataFrame, declared: StructType | str, fill: bool = False, formats: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows in the declared schema and order; a bad value fails the job.

    Schema problems are raised here, before any row is read. With ``fill`` a
    declared field that is missing becomes NULL. ``formats`` gives the pattern
    of date or timestamp columns that arrive as text, or ISO.
    """
    declared = declared_schema(declared)
    formats = formats or {}
    plain = StructType([f for f in df.schema.fields if f.name not in formats])
    check_struct("", plain, declared)
    missing = [n for n in declared.names if n not in df.columns]
    if missing and not fill:
        raise SchemaMismatch(f"declared fields {missing} are missing")
    return df.select(
        *[
            convert(F.col(f.name), df.schema[f.name].dataType, f.dataType, "cast", formats.get(f.name)).alias(f.name)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in declared.fields
        ]
    )


def conform_checked(df: DataFrame, declared: StructType | str, formats: Mapping[str, str] | None = None) -> DataFrame:
    """Declared columns (NULL where a value is bad) and ``_errors``, the bad (column, raw) pairs of the row."""
    declared = declared_schema(declared)
    formats = formats or {}
    check_struct("", StructType([f for f in df.schema.fields if f.name not in formats]), declared)
    typed, errors = [], []
    for f in declared.fields:
        if f.name not in df.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f.name)
        value = convert(raw, df.schema[f.name].dataType, f.dataType, "try_cast", formats.get(f.name))
        typed.append(value.alias(f.name))
        if df.schema[f.name].dataType != f.dataType:
            bad = F.struct(F.lit(f.name).alias("column"), raw.cast("string").alias("raw"))
            errors.append(F.when(is_bad(raw, df.schema[f.name].dataType, f.dataType, formats.get(f.name)), bad))
    found = F.filter(F.array(*errors), lambda e: e.isNotNull()) if errors else F.array()
    shape = "array<struct<column:string,raw:string>>"
    return df.select(*typed, found.cast(shape).alias("_errors"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_errors") == 0).drop("_errors")


def reject_rows(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per bad value: the row's keys, the column and the raw text."""
    return checked.filter(F.size("_errors") > 0).select(*keys, F.inline("_errors"))
