"""What several operators of this subpackage share: scratch tables, Arrow batches, word rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import files

#: The white space that separates words, in every operator here: space, tab, \n, \v, \f, \r.
SPACES = b" \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_END = np.uint64(0x9E3779B97F4A7C15)
#: Rows of a few numbers, and texts or sets of their shingles, that make a task of their own, see ``gathered``.
ROWS_A_TASK, TEXTS_A_TASK = 1 << 14, 1 << 12


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: cuts its lineage and survives lost executors."""
    spark = frame.sparkSession
    path = files.scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many tasks the cluster is laid out for after a shuffle."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def gathered(frame: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """The frame in about one partition for ``each`` of so many rows, and never in more than it has.

    ``rows`` bounds, from counts of stored tables, what its last stage reads. After a shuffle a small table lies in as many partitions as a
    large one; each that is written costs a folder and files, for which the JVM of an executor starts processes on a local file system.
    """
    return frame.coalesce(max(1, -(-rows // each)))


@contextmanager
def bounded_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside pass rows to Python in batches of about ``size`` bytes (a longer row alone)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def map_batches(frame: DataFrame, function: Callable[[dict[str, Any]], dict[str, Any] | None], schema: str) -> DataFrame:
    """Apply a function from columns to columns to every Arrow batch of a frame.

    It gets a dictionary of Arrow arrays and gives one of arrays or lists; None stands for no rows. A worker goes on to other tasks
    and stages, so at a task's end it gives back the memory that is free.
    """
    target = _arrow(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(dict(zip(batch.schema.names, batch.columns, strict=True)))
                if out is not None:
                    yield record_batch(out, target)
        release_memory()

    return frame.mapInArrow(run, schema)


def release_memory() -> None:
    """Give memory that Arrow, numpy and Python have freed back to the machine, which their allocators do not always do."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def record_batch(columns: dict[str, Any], schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns[field.name]
        if isinstance(values, (pa.Array, pa.ChunkedArray)):
            arrays.append(values.cast(field.type) if values.type != field.type else values)
        else:
            arrays.append(pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    return _arrow(spark, schema)


def encoded(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; a null is empty."""
    return [b"" if value is None else value for value in texts.cast(pa.binary()).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = values + WORD_END
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def running_total(counts: DataFrame, group: list[str], order: str, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` before each row, per group. For tables that are counts of bounded size."""
    from pyspark.sql import Window

    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(value).over(window), F.lit(0)))
