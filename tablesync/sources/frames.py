"""A source that is a DataFrame: files, a catalogue table, or anything Spark can read."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import files
from tablesync.functions.columns import ROWVER, with_rowversion
from tablesync.operators.extract import at_watermark, high_watermark, incremental


class TableSource:
    """Read the changes of one table."""

    def __init__(self, df: DataFrame) -> None:
        self.frame = df

    @property
    def spark(self) -> SparkSession:
        return self.frame.sparkSession

    def high(self, watermark_col: str, low: dt.datetime | None = None) -> dt.datetime | None:
        """The greatest watermark of the source."""
        return self.window(watermark_col, low)[0]

    def window(
        self, watermark_col: str, low: dt.datetime | None = None
    ) -> tuple[dt.datetime | None, int | None]:
        """The greatest watermark, and how many rows lie above ``low`` if that is known.

        The usual case reads only what lies above the last one. With nothing new, a row at the mark shows that it still
        is the greatest: that is looked for in the row groups around the mark, up to the first one. Only a source that
        was set back, which moves the mark back, has its whole column read.
        """
        top, rows = high_watermark(self.frame, watermark_col, low).first()
        if top is not None or low is None:
            return top, rows
        if not at_watermark(self.frame, watermark_col, low).isEmpty():
            return low, 0
        return high_watermark(self.frame, watermark_col).first()["high"], 0

    def by_timestamp(
        self, watermark_col: str, low: dt.datetime | None = None, high: dt.datetime | None = None
    ) -> DataFrame:
        if low is None and high is None:
            return self.frame
        return incremental(self.frame, watermark_col, low, high)

    def by_rowversion(self, rowver_col: str, low: int | None = None, high: int | None = None) -> DataFrame:
        """All columns plus ``__rowver``, above ``low`` and up to ``high``."""
        frame = self.frame
        if low is not None and low >= 0 and isinstance(frame.schema[rowver_col].dataType, T.BinaryType):
            # Row versions have 8 bytes, so their byte order is the order of the numbers from 0 on. This
            # comparison reaches the scan; the exact one below drops the negative numbers again.
            frame = frame.filter(F.col(rowver_col) > F.lit(bytearray(low.to_bytes(8, "big"))))
        rows = with_rowversion(frame, rowver_col)
        if low is not None:
            rows = rows.filter(F.col(ROWVER) > F.lit(low))
        if high is not None:
            within = F.col(ROWVER) <= F.lit(high)
            rows = rows.filter(within if low is not None else within | F.col(ROWVER).isNull())
        return rows

    def high_rowversion(self, rowver_col: str, low: int | None = None) -> int | None:
        """The greatest row version above ``low``, taken before the read: a row that changes meanwhile lies
        above it and waits for the next run."""
        return self.by_rowversion(rowver_col, low).agg(F.max(ROWVER)).first()[0]


@dataclass(frozen=True)
class FileLocation:
    """A folder of Parquet tables, as a place to read from or to sync into."""

    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def source(self, spark: SparkSession, table: str) -> TableSource:
        path = self._path(f"{table}.parquet")
        return TableSource(spark.read.parquet(path if files.exists(spark, path) else self._path(table)))

    def target(self, spark: SparkSession, schema: str, table: str, keys: tuple[str, ...]):
        from tablesync.sinks.bucketed import BucketedTable

        return BucketedTable.open(spark, self._path(schema, table))
