"""A delta, reduced to its last row per key and written once before anything touches the target.

The source is read exactly once: the row count, the NULL counts of the NOT NULL columns and the
greatest row version are folded by the same aggregation and summed from the written files. They are
exact even if tasks are repeated, and the merge starts from stable files, not from the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import files
from tablesync.frames import local_frame
from tablesync.functions.columns import ROWVER, as_declared, with_defaults
from tablesync.operators.fold import dedup_last
from tablesync.spec import TargetSpec

BATCH, BUCKET, ROWS = "__batch", "__bucket", "__rows"
# Where tables live for the length of one action, whatever the session's current catalogue is.
CATALOG = "spark_catalog.default"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket Spark's own bucketing and hash partitioning give a key."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write rows that carry ``__batch`` and ``__bucket`` as bucketed Parquet.

    Bucket numbers go into the file names, which only a table write does; the table is external, so
    dropping it leaves the files.
    """
    spark = df.sparkSession
    table = f"{CATALOG}.tablesync_write_{path.rstrip('/').split('/')[-1].replace('-', '_')}"
    writer = df.write.format("parquet").mode("errorifexists").option("path", path)
    try:
        writer.partitionBy(BATCH, BUCKET).bucketBy(buckets, *keys).saveAsTable(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _lines_up(spark: SparkSession, buckets: int) -> bool:
    """Whether the aggregation's shuffle already leaves each bucket in few tasks."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, buckets) % min(shuffle, buckets) == 0


@dataclass(frozen=True)
class StagedDelta:
    """A written delta: one row per key, all target columns, defaults where the source lacks one."""

    spark: SparkSession
    path: str
    spec: TargetSpec
    keys: tuple[str, ...]
    buckets: int
    bucketed: bool
    absent: tuple[str, ...]
    counts: dict[int, dict[int, int]]
    source_rows: dict[int, int]
    nulls: dict[str, int]
    max_rowver: int | None

    def batch_path(self, batch: int) -> str:
        return f"{self.path}/{BATCH}={batch}"

    def batch(self, batch: int) -> DataFrame:
        return self.spark.read.schema(self.spec.struct()).parquet(self.batch_path(batch))

    def is_other(self, folder: str) -> bool:
        """Whether a folder of the table is not one of this delta's batches, which share no key."""
        return folder.split("/")[0] != self.path.split("/")[-1]

    @property
    def batches(self) -> list[tuple[int, int]]:
        return sorted(self.source_rows.items())

    @property
    def total_rows(self) -> int:
        return sum(self.source_rows.values())

    def null_counts(self) -> DataFrame:
        return local_frame(self.spark, list(self.nulls.items()), "column_name string, nulls bigint")

    def check_keys(self) -> None:
        """A NULL in a key cannot be matched, so it is refused whether or not a run validates."""
        holes = [k for k in self.keys if self.nulls.get(k)]
        if holes:
            self.discard()
            raise ValueError(f"Key columns {holes} of '{self.spec.table}' hold NULLs in the delta.")

    def discard(self) -> None:
        files.delete_tree(self.spark, self.path)


def stage_delta(
    df: DataFrame,
    path: str,
    spec: TargetSpec,
    keys: Sequence[str],
    buckets: int,
    order_by: Sequence[str] = (),
    batches: int = 1,
    batch_by: Column | None = None,
    bucketed: bool = True,
    defaults: bool = True,
) -> StagedDelta:
    """Project to the target's columns, keep the last row per key, write, and sum up.

    A delta that will not become part of the buckets is written without bucket folders. Without
    ``defaults``, columns the delta lacks stay NULL: a database fills in its own.
    """
    if batches < 1:
        raise ValueError("batches is at least 1.")
    spark = df.sparkSession
    struct = spec.struct()
    present = [c for c in spec.names if c in df.columns]
    absent = tuple(c for c in spec.names if c not in df.columns)
    missing = [k for k in keys if k not in present]
    if missing:
        raise ValueError(f"Key columns {missing} are absent from the delta for '{spec.table}'.")
    required = [c for c in present if c in keys or c in spec.required]
    helpers = [c for c in dict.fromkeys([*order_by, ROWVER]) if c in df.columns and c not in present]
    rows = df.select(
        *[as_declared(df, c, struct[c].dataType).alias(c) for c in present],
        *[F.col(c).alias(f"__order_{c}") for c in helpers],
        (batch_by if batch_by is not None else F.lit(None)).cast("int").alias(BATCH),
    )
    if batch_by is None:
        rows = rows.drop(BATCH)
    counters = {ROWS: F.count(F.lit(1))}
    for i, c in enumerate(required):
        counters[f"__nulls_{i}"] = F.count_if(F.col(c).isNull())
    if ROWVER in df.columns:
        counters["__max_rowver"] = F.max(ROWVER if ROWVER in present else f"__order_{ROWVER}")
    order = [c if c in present else f"__order_{c}" for c in order_by if c in df.columns]
    folded = with_defaults(dedup_last(rows, keys, order, counters), spec if defaults else spec.without_defaults())
    bucket = bucket_of(keys, buckets)
    batch = F.pmod(bucket, F.lit(batches))
    if batch_by is not None:
        # One summary row per batch and bucket reaches the driver, so their number is fixed beforehand.
        fits = F.col(BATCH).between(0, batches - 1)
        refused = F.concat(F.lit("batch_by gives "), F.coalesce(F.col(BATCH).cast("string"), F.lit("NULL")), F.lit(f", not 0 to {batches - 1}."))
        batch = F.when(fits, F.col(BATCH)).otherwise(F.raise_error(refused).cast("int"))
    staged = folded.select(
        *spec.names, *counters, batch.cast("int").alias(BATCH), bucket.alias(BUCKET)
    )
    if not bucketed:
        staged.write.partitionBy(BATCH).parquet(path)
    else:
        if not _lines_up(spark, buckets):
            staged = staged.repartition(buckets, *keys)
        write_bucketed(staged, path, keys, buckets)

    written = spark.read.schema(staged.schema).parquet(path)
    sums = [F.sum(c).alias(c) for c in counters if c != "__max_rowver"]
    top = [F.max("__max_rowver").alias("__max_rowver")] if "__max_rowver" in counters else []
    # At most one row per batch and bucket.
    parts = written.groupBy(BATCH, BUCKET).agg(F.count(F.lit(1)).alias("__keys"), *sums, *top).collect()
    counts: dict[int, dict[int, int]] = {}
    source_rows: dict[int, int] = {}
    for part in parts:
        counts.setdefault(part[BATCH], {})[part[BUCKET]] = part["__keys"]
        source_rows[part[BATCH]] = source_rows.get(part[BATCH], 0) + part[ROWS]
    tops = [p["__max_rowver"] for p in parts if top and p["__max_rowver"] is not None]
    return StagedDelta(
        spark=spark,
        path=path,
        spec=spec,
        keys=tuple(keys),
        buckets=buckets,
        bucketed=bucketed,
        absent=absent,
        counts=counts,
        source_rows=source_rows,
        nulls={c: sum(p[f"__nulls_{i}"] for p in parts) for i, c in enumerate(required)},
        max_rowver=max(tops, default=None),
    )
