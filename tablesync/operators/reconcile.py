"""Compare a source with its target: counts and maxima, and what differs, down to the key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import mark_literal


def count_since(df: DataFrame, column: str, since: dt.datetime) -> DataFrame:
    """Number of rows at or after a time."""
    bound = mark_literal(since, df.schema[column].dataType)
    return df.filter(F.col(column) >= bound).agg(F.count("*").alias("n"))


def reconcile(source: DataFrame, target: DataFrame, watermark_col: str) -> DataFrame:
    """Count and greatest watermark of both sides, one row each."""

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("side"), F.count("*").alias("n"), F.max(watermark_col).alias("max_w")
        )

    return side("source", source).unionByName(side("target", target))


#: Rows a bucket of a comparison should hold: what is compared row by row where one row differs.
BUCKET_ROWS = 100_000


def _row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """128 bits of a row: two hashes over values and NULLs, the same for the same row on both sides."""
    flags = [F.col(c).isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *columns, *flags).alias(f"__h{seed}") for seed in (0, 1)]


def _hashed(df: DataFrame, columns: Sequence[str], keys: Sequence[str], buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
    return df.select(*keys, bucket, *_row_hashes(df, columns))


def bucket_checksums(df: DataFrame, columns: Sequence[str], keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows and a checksum of each hash bucket of the keys, whatever the order of the rows and however often tasks ran.

    Sums, not exclusive ors, so that rows that are there twice count. One aggregate that folds before its shuffle.
    """
    wide = [F.sum(F.col(h).cast("decimal(38,0)")).alias(h) for h in ("__h0", "__h1")]
    return _hashed(df, columns, keys, buckets).groupBy("bucket").agg(F.count("*").alias("n"), *wide)


def differing_buckets(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = 1024
) -> DataFrame:
    """``bucket``, ``n_source`` and ``n_target`` of the buckets whose checksums are not the same; no row if the sides are equal.

    ``columns`` defaults to those both sides have; values of a column are compared in the source's type.
    """
    source, target, columns = _alike(source, target, keys, columns)
    left = bucket_checksums(source, columns, keys, buckets).withColumnsRenamed({"n": "n_source", "__h0": "s0", "__h1": "s1"})
    right = bucket_checksums(target, columns, keys, buckets).withColumnsRenamed({"n": "n_target", "__h0": "t0", "__h1": "t1"})
    same = F.col("n_source").eqNullSafe(F.col("n_target")) & F.col("s0").eqNullSafe(F.col("t0")) & F.col("s1").eqNullSafe(F.col("t1"))
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_source", "n_target")]
    return left.join(right, "bucket", "full").where(~same).select("bucket", *counts)


def differences(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = 1024
) -> DataFrame:
    """The keys that differ: ``kind`` is ``missing`` (in the target), ``extra`` or ``changed``.

    Only rows of buckets whose checksums differ are shuffled and compared, so equal tables cost two aggregates, and a few changed
    rows those and their buckets: choose ``buckets`` so that one holds about BUCKET_ROWS. A key that a side holds several times
    counts as changed where its rows differ in number or values; NULLs in keys compare like values.
    """
    source, target, columns = _alike(source, target, keys, columns)
    found = differing_buckets(source, target, keys, columns, buckets).select("bucket")
    # At most one small row per bucket.
    found = F.broadcast(found.limit(buckets))

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = _hashed(df, columns, keys, buckets).join(found, "bucket", "left_semi")
        sums = [F.sum(F.col(h).cast("decimal(38,0)")).alias(f"{name}_{h}") for h in ("__h0", "__h1")]
        return rows.groupBy(*keys).agg(F.count("*").alias(name), *sums)

    left, right = side(source, "s"), side(target, "t").withColumnsRenamed({k: f"__t_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys]
    joined = left.join(right, match, "full")
    kind = (
        F.when(F.col("t").isNull(), "missing")
        .when(F.col("s").isNull(), "extra")
        .when((F.col("s") != F.col("t")) | (F.col("s___h0") != F.col("t___h0")) | (F.col("s___h1") != F.col("t___h1")), "changed")
    )
    own = [F.when(F.col("s").isNull(), F.col(f"__t_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return joined.select(*own, kind.alias("kind")).where("kind IS NOT NULL")


def _alike(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the same columns in the same types."""
    listed = list(columns) if columns is not None else [c for c in source.columns if c in target.columns]
    needed = list(dict.fromkeys([*keys, *listed]))
    types = {f.name: f.dataType for f in source.schema}
    return source.select(*needed), target.select(*[F.col(c).cast(types[c]).alias(c) for c in needed]), needed
