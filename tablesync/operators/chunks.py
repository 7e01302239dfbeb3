"""Chunk numbering of an ordered delta, its report, and ordered or random top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.files import checkpoint_root


def _load_order(watermark_col: str, keys: Sequence[str]) -> list[Column]:
    """Watermark order, NULLs last; the key makes ties total."""
    return [F.col(watermark_col).asc_nulls_last(), *[F.col(k).asc() for k in keys if k != watermark_col]]


def assign_chunks(df: DataFrame, watermark_col: str, keys: Sequence[str], chunk_size: int) -> DataFrame:
    """Add ``chunk``: the position in watermark order divided by the chunk size.

    A range sort on (watermark, key) spreads even a single hot watermark over tasks, since the key is
    part of the sort. Within a sorted partition ``monotonically_increasing_id`` counts the rows from
    0 in its lower 33 bits and names the partition above them; the offset of a partition is the sum
    of the sizes before it, one row per partition. The sorted rows are checkpointed first: the range
    bounds are sampled, so both uses must see the same ones. Project to what is needed beforehand.
    """
    checkpoint_root(df.sparkSession)
    position = F.monotonically_increasing_id()
    rows = (
        df.orderBy(*_load_order(watermark_col, keys))
        .withColumn("__pos", position)
        .checkpoint(eager=True)
        .withColumn("__part", F.shiftright("__pos", 33))
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .select("__part", "__offset")
    )
    in_part = F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per sort partition, so the size of the broadcast is fixed by the partition count.
    return (
        rows.join(F.broadcast(offsets), "__part")
        .withColumn("__row", F.col("__offset") + in_part)
        .select(*df.columns, F.expr(f"__row div {int(chunk_size)}").alias("chunk"))
    )


def chunk_report(df: DataFrame, chunk_size: int) -> DataFrame:
    """One row per chunk: index, rows, cumulative rows, and whether it is the last.

    Only the row count matters, so nothing is sorted; the report itself is generated in parallel.
    """
    total = df.count()
    chunks = -(-total // chunk_size)
    end = F.least((F.col("id") + 1) * chunk_size, F.lit(total))
    return df.sparkSession.range(chunks).select(
        F.col("id").alias("chunk"),
        (end - F.col("id") * chunk_size).alias("n"),
        end.alias("cumulative"),
        (F.col("id") == chunks - 1).alias("is_final"),
    )


# Ranks of an approximate quantile are exact to one part in so many.
ACCURACY = 10_000
# Quantiles that are taken in one pass with the count; each is half of the next.
SHARES = [2.0**-k for k in range(13, 0, -1)]


def first_chunk(df: DataFrame, watermark_col: str, keys: Sequence[str], chunk_size: int) -> DataFrame:
    """The first chunk alone, without a full sort.

    A top-n collects the first rows of every task in one task, so rows above an approximate quantile of
    the watermark are dropped before. One pass gives the count and a ladder of quantiles, of which the lowest that surely
    leaves a chunk is taken: its share has room for the error, and NULLs come last.
    """
    mark = _number(df, watermark_col)
    if mark is not None:
        ladder = F.percentile_approx(mark, F.array(*map(F.lit, SHARES)), F.lit(ACCURACY))
        known, bounds = df.agg(F.count(watermark_col), ladder).first()
        least = 2 * (chunk_size + 1) / max(known, 1) + 2 / ACCURACY
        enough = [bound for share, bound in zip(SHARES, bounds or [], strict=False) if share >= least]
        if enough:
            df = df.filter(mark <= F.lit(enough[0]))
    return df.orderBy(*_load_order(watermark_col, keys)).limit(chunk_size)


def _number(df: DataFrame, column: str) -> Column | None:
    """A column in whose order a quantile can be taken."""
    kind = df.schema[column].dataType
    if kind.typeName() in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column) if isinstance(kind, (T.IntegralType, T.FractionalType)) else None


def sample_rows(df: DataFrame, n: int, keys: Sequence[str] = (), seed: int | None = None) -> DataFrame:
    """``n`` rows in random order; with keys, the same rows every time (ordered by their hash)."""
    if keys:
        rank = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
        return df.orderBy(rank, *keys).limit(n)
    return df.orderBy(F.rand(seed)).limit(n)
