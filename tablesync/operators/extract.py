"""Incremental reads: the rows above the stored watermark, up to the one taken at the start."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import mark_literal


def incremental(
    df: DataFrame,
    watermark_col: str,
    low: dt.datetime | int | None = None,
    high: dt.datetime | int | None = None,
) -> DataFrame:
    """Rows with ``low < watermark <= high``.

    Without ``low`` it is the full snapshot, including the rows whose watermark is NULL; with it
    those rows never qualify. ``high`` bounds the read, so rows that arrive later wait for the next run.
    """
    column = F.col(watermark_col)
    data_type = df.schema[watermark_col].dataType
    rows = df
    if low is not None:
        rows = rows.filter(column > mark_literal(low, data_type))
    if high is not None:
        within = column <= mark_literal(high, data_type)
        rows = rows.filter(within if low is not None else within | column.isNull())
    return rows


def at_watermark(df: DataFrame, watermark_col: str, mark: dt.datetime | int) -> DataFrame:
    """The rows whose watermark is a given one, without their columns. The comparison reaches the scan."""
    return df.filter(F.col(watermark_col) == mark_literal(mark, df.schema[watermark_col].dataType)).select(watermark_col)


def high_watermark(df: DataFrame, watermark_col: str, low: dt.datetime | int | None = None) -> DataFrame:
    """One row ``high, rows``: the greatest watermark above ``low``, NULL when there is none, and the
    number of rows there.

    ``low`` lets the scan skip row groups below the last run. Zoned timestamps lose their zone and
    keep the session's wall clock.
    """
    rows = incremental(df, watermark_col, low)
    column = F.max(watermark_col)
    if df.schema[watermark_col].dataType.typeName() in ("timestamp", "date"):
        column = column.cast("timestamp_ntz")
    return rows.agg(column.alias("high"), F.count(F.lit(1)).alias("rows"))
