"""The watermark store: two independent slots for each source and target."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tablesync.frames import local_frame
from tablesync.sinks import versions
from tablesync.sinks.bucketed import BucketedTable
from tablesync.sinks.report import Mark

MARK_SCHEMA = (
    "table_name string, target_table string, last_value timestamp_ntz, last_rowver bigint, "
    "updated_at timestamp_ntz"
)


class WatermarkStore:
    """Watermarks at a path, by (source, target). Nothing needs to be there before the first update.

    Parquet targets keep their watermark in their own version file, where it commits with the rows.
    This store serves database targets and callers that keep watermarks themselves.
    """

    _writing = threading.Lock()

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self) -> DataFrame:
        """One row per source and target."""
        return local_frame(self.spark, versions.latest(self.spark, self.path).mark_rows(), MARK_SCHEMA)

    def mark(self, source: str, target: str | None = None) -> Mark:
        return versions.latest(self.spark, self.path).mark(source, target or source)

    def get_last_timestamp(self, source: str, target: str | None = None) -> dt.datetime | None:
        return self.mark(source, target).last_value

    def get_last_rowversion(self, source: str, target: str | None = None) -> int | None:
        return self.mark(source, target).last_rowver

    def update_timestamp(self, source: str, value: dt.datetime, target: str | None = None) -> None:
        self._put(source, target, last_value=value.replace(tzinfo=None))

    def update_rowversion(self, source: str, value: int, target: str | None = None) -> None:
        self._put(source, target, last_rowver=value)

    def _put(self, source: str, target: str | None, **slot: dt.datetime | int) -> None:
        """Set one slot; the other keeps its value. Tables synced side by side take turns."""
        target = target or source
        with self._writing:
            current = versions.latest(self.spark, self.path)
            mark = replace(current.mark(source, target), **slot)
            versions.publish(self.spark, self.path, current.with_mark(source, target, mark))


def marks_frame(spark: SparkSession, tables: Iterable[BucketedTable]) -> DataFrame:
    """The watermarks kept by the given tables, one row per source and target."""
    rows = [row for table in tables for row in table.version().mark_rows()]
    return local_frame(spark, rows, MARK_SCHEMA)
