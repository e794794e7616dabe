"""Readers. Paths are Hadoop paths: local, ``s3a://``, ``hdfs://``, with globs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludomart.functions import lenient_int


def read_csv(
    spark: SparkSession, path: str, schema: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header, doubled quotes and newlines inside quotes.

    Columns are found by the header, whatever their order; ``aliases`` maps other
    header names to those of ``schema``, and an absent column is NULL. Only the
    header is read ahead. The files of one path share one header: a file with another
    stops the read, as its values would otherwise land in the wrong columns. Text that
    is no value of the column's type becomes NULL.
    """
    text = spark.read.csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    return named_columns(text, schema, aliases)


def named_columns(text: DataFrame, schema: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Columns of text, found by name or alias, as the types of ``schema``."""
    names = {(aliases or {}).get(c, c): c for c in text.columns}

    def typed(field: T.StructField) -> Column:
        if field.name not in names:
            return F.lit(None).cast(field.dataType)
        return _lenient(F.col(f"`{names[field.name]}`"), field.dataType)

    fields = T.StructType.fromDDL(schema).fields
    return text.select(*[typed(f).alias(f.name) for f in fields])


def _lenient(value: Column, kind: T.DataType) -> Column:
    """Text as a value of a scalar type; ``1999.0`` is an integer."""
    if isinstance(kind, T.IntegerType):
        return lenient_int(value)
    if isinstance(kind, T.LongType):
        return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
    return value.try_cast(kind)


def read_json_arrays(
    spark: SparkSession, path: str, schema: str, recursive: bool = False
) -> DataFrame:
    """Files that each hold one array of objects, or one object. One task reads one
    file, so big dumps want many files or ``plans.landing.compact_json`` first.

    Scalars are read as text and typed then, so a quoted number or ``1999.0`` is no NULL."""
    text = spark.read.schema(json_raw(schema)).json(path, multiLine=True, recursiveFileLookup=recursive)
    return text.select(*json_columns(schema))


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def json_raw(schema: str) -> T.StructType:
    """``schema`` with scalars as text."""
    fields = T.StructType.fromDDL(schema).fields
    return T.StructType([T.StructField(f.name, f.dataType if _is_nested(f.dataType) else T.StringType()) for f in fields])


def json_columns(schema: str, within: str | None = None) -> list[Column]:
    """Columns of ``json_raw``, or fields of the struct ``within``, as the types of ``schema``."""

    def typed(f: T.StructField) -> Column:
        value = F.col(within).getField(f.name) if within else F.col(f"`{f.name}`")
        return (value if _is_nested(f.dataType) else _lenient(value, f.dataType)).alias(f.name)

    return [typed(f) for f in T.StructType.fromDDL(schema).fields]


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """One row per ``row_tag`` element; attributes arrive with a leading underscore."""
    return spark.read.schema(schema).format("xml").option("rowTag", row_tag).load(path)
