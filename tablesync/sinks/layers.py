"""Layers: what single loads changed above the buckets of a table.

However many loads there were, few layers are left: newer ones that are not smaller than older ones become one with them,
and so do FAN of a size. Sizes go in tiers, each FAN times the one before. So a row is rewritten once per tier it climbs, and ``n`` loads leave at
most FAN - 1 layers in each of O(log n) tiers. All layers are one scan: the folder of a file tells its layer.

A load that lacks columns is a layer all the same. Its rows hold the defaults there, for keys that are new; for others the
last layer that has a value decides, column by column, and below the layers the buckets do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.sinks.staging import BATCH

LAYER = "__layer"
FAN = 4
#: Layers with fewer rows than this are of one size.
SMALL_ROWS = 1 << 16


@dataclass(frozen=True)
class Layer:
    """A folder below the table, its rows (one per key), and the columns that some or all of them lack."""

    folder: str
    rows: int
    absent: tuple[str, ...] = ()

    @property
    def tier(self) -> int:
        tier, rows = 0, self.rows // SMALL_ROWS
        while rows:
            tier, rows = tier + 1, rows // FAN
        return tier

    def to_json(self) -> list[Any]:
        return [self.folder, self.rows, list(self.absent)]

    @classmethod
    def from_json(cls, value: Sequence[Any]) -> Layer:
        return cls(value[0], value[1], tuple(value[2]) if len(value) > 2 else ())


def newest_to_merge(layers: Sequence[Layer]) -> int:
    """How many of the newest layers are to become one; 0 if none are."""
    merged, sizes = 0, list(layers)
    while sizes:
        top = sizes[-1].tier
        run = 0
        while run < len(sizes) and sizes[-1 - run].tier <= top:
            run += 1
        smaller = any(layer.tier < top for layer in sizes[-run:])
        if run < 2 or not (smaller or run >= FAN):
            return merged
        merged = len(layers) - len(sizes) + run
        sizes[-run:] = [Layer("", sum(layer.rows for layer in sizes[-run:]))]
    return merged


def given(column: str) -> str:
    """The flag that tells whether a row has a value of its own in a column."""
    return f"__given_{column}"


def lacking(layers: Sequence[Layer], struct: T.StructType) -> list[str]:
    """Columns that some layer lacks."""
    return [c for c in struct.names if any(c in layer.absent for layer in layers)]


def stacked(spark: SparkSession, path: str, layers: Sequence[Layer], struct: T.StructType) -> DataFrame:
    """All rows of some layers in one scan, with the layer's number and flags for the columns that some layer lacks."""
    sparse = lacking(layers, struct)
    schema = T.StructType([*struct, *[T.StructField(given(c), T.BooleanType()) for c in sparse]])
    # Without a look for partitions: a first load that another one overtook lies in bucket folders.
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    rows = reader.parquet(*[f"{path}/{layer.folder}" for layer in layers])
    mark = f"/{BATCH}="
    file = F.col("_metadata.file_path")
    run = F.substring_index(F.substring_index(file, mark, 1), "/", -1)
    folder = F.concat(run, F.lit(mark), F.substring_index(F.substring_index(file, mark, -1), "/", 1))
    numbers = F.create_map(*[F.lit(x) for k, layer in enumerate(layers) for x in (layer.folder, k)])
    number = F.element_at(numbers, folder) if len(layers) > 1 else F.lit(0)
    flagged = rows.select(*struct.names, *[given(c) for c in sparse], number.alias(LAYER))
    for c in sparse:
        # A layer as it was loaded has no flags in its files; a merged one has.
        bare = F.col(LAYER).isin([k for k, layer in enumerate(layers) if c in layer.absent])
        flagged = flagged.withColumn(given(c), F.coalesce(F.col(given(c)), ~bare))
    return flagged


def last_given(rows: DataFrame, keys: Sequence[str], names: Sequence[str], sparse: Sequence[str]) -> DataFrame:
    """One row per key of stacked layers: for each column the value of the last layer that has one, with flags for the sparse
    columns. Where none has, the default of the first: that of the key's insertion."""
    whole = [c for c in names if c not in keys and c not in sparse]
    found: list[Column] = []
    if whole:
        found.append(F.max_by(F.struct(*whole), LAYER).alias("__last"))
    for c in sparse:
        rank = F.when(F.col(given(c)), F.col(LAYER)).otherwise(-1 - F.col(LAYER))
        found += [F.max_by(c, rank).alias(f"__value_{c}"), (F.max(rank) >= 0).alias(given(c))]
    if not found:
        return rows.select(*keys).distinct()
    folded = rows.groupBy(*keys).agg(*found)
    values = {c: F.col(f"__last.`{c}`") for c in whole} | {c: F.col(f"__value_{c}") for c in sparse}
    return folded.select(*[F.col(c) if c in keys else values[c].alias(c) for c in names], *[given(c) for c in sparse])


def merged(spark: SparkSession, path: str, layers: Sequence[Layer], struct: T.StructType, keys: Sequence[str]) -> DataFrame:
    """What some layers that follow each other come to: the rows of the one that replaces them."""
    rows, sparse = stacked(spark, path, layers, struct), lacking(layers, struct)
    if len(layers) == 1:
        return rows.drop(LAYER)
    return last_given(rows, keys, struct.names, sparse)


def filled(changes: DataFrame, below: DataFrame, keys: Sequence[str], sparse: Sequence[str]) -> DataFrame:
    """Give changes the values from below in the columns that no layer has a value for; a key that is not there keeps its defaults."""
    if not sparse:
        return changes
    held = below.select(*keys, *[F.col(c).alias(f"__was_{c}") for c in sparse], F.lit(True).alias("__hit"))
    hits = held.join(changes.select(*keys), list(keys), "left_semi")
    names = [c for c in changes.columns if not c.startswith("__given_")]
    joined = changes.join(hits, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("__hit") & ~F.col(given(c)), F.col(f"__was_{c}")).otherwise(F.col(c)).alias(c) if c in sparse else F.col(c)
            for c in names
        ]
    )
