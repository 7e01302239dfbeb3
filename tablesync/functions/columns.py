"""Scalar expressions of a sync, all built in and JVM-side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.spec import TargetSpec

ROWVER = "__rowver"


def decode_rowversion(column: Column | str) -> Column:
    """An 8-byte big-endian row version as a signed bigint.

    The target base -10 makes ``conv`` signed, so ``FF..FF`` is -1 and ``80..00`` the least bigint.
    """
    return F.conv(F.hex(column), 16, -10).cast("bigint")


def with_rowversion(df: DataFrame, rowver_col: str) -> DataFrame:
    """Add the decoded row version; the raw column stays. An integer column is taken as it is."""
    if ROWVER in df.columns:
        return df
    if isinstance(df.schema[rowver_col].dataType, T.BinaryType):
        return df.withColumn(ROWVER, decode_rowversion(F.col(rowver_col)))
    return df.withColumn(ROWVER, F.col(rowver_col).cast("bigint"))


def mark_literal(value: dt.datetime | int, data_type: T.DataType) -> Column:
    """A stored watermark as a literal of the column's own type, so that the filter is pushed down.

    A timestamp goes through text: ``lit(datetime)`` would shift it by the driver's time zone.
    """
    if isinstance(value, int):
        return F.lit(value).cast(data_type)
    text = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz").cast(data_type)


def as_declared(df: DataFrame, name: str, declared: T.DataType) -> Column:
    """A column in its declared type; nested values become JSON text, not Spark's display of them."""
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    value = F.to_json(F.col(name)) if nested and isinstance(declared, T.StringType) else F.col(name)
    return value.cast(declared)


def with_generated(df: DataFrame, name: str, expression: Column | str, data_type: str) -> DataFrame:
    """Add a generated column of a declared type."""
    value = F.expr(expression) if isinstance(expression, str) else expression
    return df.withColumn(name, value.cast(data_type))


def with_defaults(df: DataFrame, spec: TargetSpec) -> DataFrame:
    """Add the target columns the frame lacks, with their default or NULL.

    A NULL that is present stays NULL: a default stands in for an omitted column only.
    """
    struct = spec.struct()
    added = {
        c.name: (F.expr(c.default) if c.default is not None else F.lit(None)).cast(struct[c.name].dataType)
        for c in spec.columns
        if c.name not in df.columns
    }
    return df.withColumns(added) if added else df
