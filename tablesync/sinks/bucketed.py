"""A keyed target table on Parquet.

Rows lie in ``buckets`` hash buckets of the key, in the layout of Spark's own bucketed tables. A load
does not touch them: whatever its size, the delta becomes a layer whose keys hide the same keys below it,
so a load writes as many rows as it brings and reads nothing of the target. Layers become fewer and larger
as they come (:mod:`tablesync.sinks.layers`), so a reader meets few of them, all in one scan.
:meth:`BucketedTable.compact` moves them into the buckets, joining each bucket where it lies: the target is
not shuffled. Every load writes new folders only.
A small JSON file per version lists what is live together with the watermark, so rows and watermark
appear at once, a crash leaves the old version, and frames that were read before stay readable. One
writer per table at a time.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import files
from tablesync.frames import local_frame
from tablesync.functions.columns import as_declared, with_defaults
from tablesync.operators.merge import merge_frames
from tablesync.sinks import versions
from tablesync.sinks.layers import Layer, filled, lacking, merged, newest_to_merge
from tablesync.sinks.report import LoadSummary, Mark, PartialLoadError, run_batches
from tablesync.sinks.staging import BATCH, BUCKET, CATALOG, StagedDelta, bucket_of, stage_delta, write_bucketed
from tablesync.sinks.versions import Live, Version
from tablesync.spec import SyncConfig, TargetSpec

FOLDER = "__folder"
log = logging.getLogger("tablesync")


def suggest_buckets(spark: SparkSession, *paths: str, bucket_bytes: int = 8 << 30, least: int = 8) -> int:
    """Bucket count for data like that at the given paths: a power of two, so that it lines up with a
    power of two of shuffle partitions."""
    wanted = max(sum(files.total_bytes(spark, p) for p in paths) // bucket_bytes, least)
    return 1 << (wanted - 1).bit_length()


class BucketedTable:
    """Open with :meth:`open`, make with :meth:`create`."""

    def __init__(
        self, spark: SparkSession, path: str, spec: TargetSpec, keys: Sequence[str], buckets: int
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.keys = tuple(keys)
        self.buckets = buckets

    # -- definition ---------------------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        spec: TargetSpec,
        keys: Sequence[str],
        buckets: int | None = None,
        recreate: bool = False,
    ) -> BucketedTable:
        """Create the table if it is missing; an existing one is opened unchanged.

        Key columns reject NULL. The bucket count is fixed here. It defaults to the shuffle partitions;
        at scale, size it so that a bucket is some gigabytes (:func:`suggest_buckets`).
        """
        if recreate:
            cls.drop(spark, path)
        found = cls.open(spark, path)
        if found is not None:
            return found
        unknown = [k for k in keys if k not in spec.names]
        if unknown:
            raise ValueError(f"Key columns {unknown} are not columns of '{spec.table}'.")
        columns = tuple(replace(c, nullable=False) if c.name in keys else c for c in spec.columns)
        spec = replace(spec, columns=columns)
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        definition = {"spec": spec.to_json(), "keys": list(keys), "buckets": count}
        files.publish_text(spark, f"{path.rstrip('/')}/_table.json", json.dumps(definition))
        return cls(spark, path, spec, keys, count)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketedTable | None:
        """The table at a path, or None."""
        definition = f"{path.rstrip('/')}/_table.json"
        if not files.exists(spark, definition):
            return None
        value = json.loads(files.read_text(spark, definition))
        return cls(spark, path, TargetSpec.from_json(value["spec"]), value["keys"], value["buckets"])

    @staticmethod
    def drop(spark: SparkSession, path: str) -> None:
        """Remove the table if it exists. Only a folder that holds a table is touched."""
        if files.exists(spark, f"{path.rstrip('/')}/_table.json"):
            files.delete_tree(spark, path)

    # -- reading ------------------------------------------------------------------------------

    def version(self) -> Version:
        return versions.latest(self.spark, self.path)

    def read(self) -> DataFrame:
        """The current rows. Later loads do not change a frame that was read before."""
        version = self.version()
        paths = [
            f"{self.path}/{folder}/{BUCKET}={bucket}"
            for bucket, parts in sorted(version.live.items())
            for folder, _ in parts
        ]
        changes = self._changes(version)
        if not paths:
            return local_frame(self.spark, [], self.spec.struct()) if changes is None else changes.select(*self.spec.names)
        base = self.spark.read.schema(self.spec.struct()).parquet(*paths)
        return base if changes is None else self._over(base, changes, version)

    def _changes(self, version: Version) -> DataFrame | None:
        """The last row of each key in the layers."""
        if not version.layers:
            return None
        return merged(self.spark, self.path, version.layers, self.spec.struct(), self.keys)

    def _over(self, base: DataFrame, changes: DataFrame, version: Version) -> DataFrame:
        """Rows of the buckets under the changes."""
        whole = filled(changes, base, self.keys, lacking(version.layers, self.spec.struct()))
        return merge_frames(base, whole, self.keys, changes)

    def is_empty(self) -> bool:
        version = self.version()
        return version.bucket_rows + version.layer_rows == 0

    def mark(self, source: str) -> Mark:
        return self.version().mark(source, self.spec.table)

    @contextmanager
    def _bucketed(self, live: Live, wanted: Iterable[int]) -> Iterator[DataFrame]:
        """Some live buckets as a bucketed table, for the length of one action."""
        name = f"{CATALOG}.tablesync_read_{uuid.uuid4().hex}"
        path = self.path.replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.struct())
        keys = ", ".join(f"`{k}`" for k in self.keys)
        parts = [
            f"PARTITION (`{FOLDER}`='{folder}', `{BUCKET}`={bucket}) "
            f"LOCATION '{path}/{folder}/{BUCKET}={bucket}'"
            for bucket in sorted(wanted)
            for folder, _ in live[bucket]
        ]
        try:
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, `{FOLDER}` STRING, `{BUCKET}` INT) USING parquet "
                f"PARTITIONED BY (`{FOLDER}`, `{BUCKET}`) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{path}'"
            )
            for start in range(0, len(parts), 1000):
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[start : start + 1000])}")
            yield self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # -- loading ------------------------------------------------------------------------------

    def stage(
        self,
        df: DataFrame,
        order_by: Sequence[str] = (),
        batches: int = 1,
        batch_by: Column | None = None,
    ) -> StagedDelta:
        """Read the delta once and write its last row per key next to the table's data.

        The rows of an empty table go to its buckets, later ones become layers.
        """
        path = f"{self.path}/{uuid.uuid4().hex}"
        first = self.is_empty()
        return stage_delta(df, path, self.spec, self.keys, self.buckets, order_by, batches, batch_by, first)

    def load(
        self,
        staged: StagedDelta,
        source: str | None = None,
        mark: Mark | None = None,
        config: SyncConfig = SyncConfig(),
        stream: tuple[str, int] | None = None,
    ) -> LoadSummary:
        """Add a staged delta to the table. Its batches are prepared side by side, and those that succeed appear together.

        The mark is stored with them if none failed, and so is the micro-batch they came from (``stream``: a stream's id and
        the batch's number). Layers that are due are merged afterwards.
        """
        staged.check_keys()

        def finish(loaded: list[int], complete: bool) -> None:
            following = self.version()
            for batch in loaded:
                following = self._with_batch(staged, batch, following)
            if complete and stream is not None:
                following = following.with_batch(*stream)
            self._commit(following, source if complete else None, mark)

        def prepare(batch: int, final: bool) -> None:
            self._prepare(staged, batch)

        summary = run_batches(staged.batches, prepare, config, self.spec.table, last_alone=False, finish=finish)
        if not staged.batches:
            staged.discard()
            if source is not None and mark is not None:
                self.record(source, mark)
        elif summary.chunks_ok:
            self._merge_due_layers()
        return summary

    def loaded_batch(self, stream: str) -> int | None:
        """The last micro-batch of a stream that is in the table."""
        return self.version().streams.get(stream)

    def record(self, source: str, mark: Mark) -> None:
        """Store a watermark without loading anything."""
        if mark != self.mark(source):
            self._commit(self.version(), source, mark)

    def upsert(
        self,
        df: DataFrame,
        order_by: Sequence[str] = (),
        batches: int = 1,
        batch_by: Column | None = None,
        config: SyncConfig = SyncConfig(),
    ) -> LoadSummary:
        """Insert new keys and overwrite the delta's columns of existing ones.

        Columns the delta lacks keep their value, and take their default on insert. Raises if a batch
        fails; :meth:`load` reports it instead.
        """
        summary = self.load(self.stage(df, order_by, batches, batch_by), config=config)
        if summary.chunks_failed:
            raise PartialLoadError(self.spec.table, summary)
        return summary

    def append(self, df: DataFrame) -> None:
        """Add rows without looking at keys. NULLs in keys and NOT NULL columns are refused.

        Keys may repeat here, so a bucket can be large: adaptive execution splits it over tasks. The rows go to the buckets;
        layers, which would hide them, are compacted first, so on a table with layers this costs a :meth:`compact`.
        """
        path = f"{self.path}/{uuid.uuid4().hex}"
        struct = self.spec.struct()
        rows = with_defaults(df.select(*[c for c in self.spec.names if c in df.columns]), self.spec)
        rows = rows.select(
            *[as_declared(rows, c, struct[c].dataType).alias(c) for c in self.spec.names],
            F.lit(0).alias(BATCH),
            bucket_of(self.keys, self.buckets).alias(BUCKET),
        )
        write_bucketed(rows.hint("rebalance", BUCKET), path, self.keys, self.buckets)
        folder = f"{path.split('/')[-1]}/{BATCH}=0"
        self._refuse_nulls(folder)
        version = self._without_layers(self.version())
        live = dict(version.live)
        for bucket, n in self._written(folder).items():
            live[bucket] = [*live.get(bucket, []), (folder, n)]
        self._commit(replace(version, live=live))

    def _refuse_nulls(self, folder: str) -> None:
        path = f"{self.path}/{folder}"
        if not self.spec.required or not files.exists(self.spark, path):
            return
        written = self.spark.read.schema(self.spec.struct()).parquet(path)
        nulls = written.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in self.spec.required]).first()
        holes = [c for c in self.spec.required if nulls[c]]
        if holes:
            files.delete_tree(self.spark, path.rsplit("/", 1)[0])
            raise ValueError(f"Columns {holes} of '{self.spec.table}' hold NULLs in the appended rows.")

    def compact(self) -> None:
        """Move the layers into the buckets, so that readers need not hide rows. Call it when reads, not loads, are to be fast."""
        version = self.version()
        if version.layers:
            self._commit(self._without_layers(version))

    def _without_layers(self, version: Version) -> Version:
        changes = self._changes(version)
        if changes is None:
            return version
        folder = f"{uuid.uuid4().hex}/{BATCH}=0"
        sparse = lacking(version.layers, self.spec.struct())
        if sparse and any(version.live.values()):
            with self._bucketed(version.live, version.live) as base:
                self._write_placed(filled(changes, base, self.keys, sparse), folder)
        else:
            self._write_placed(changes.select(*self.spec.names), folder)
        return version.with_live(self._into_buckets(folder, self._written(folder), version.live))

    def _merge_due_layers(self) -> None:
        """Keep the layers few. The rows are in the table already, so an error here only puts the merge off."""
        try:
            version = self.version()
            many = newest_to_merge(version.layers)
            if many:
                self._commit(version.with_layer(self._merged_layer(version.layers[-many:]), many))
        except Exception as error:
            log.warning("%s: layers were not merged: %s", self.spec.table, error)

    def _merged_layer(self, layers: Sequence[Layer]) -> Layer:
        struct = self.spec.struct()
        rows = merged(self.spark, self.path, layers, struct, self.keys)
        folder = f"{uuid.uuid4().hex}/{BATCH}=0"
        rows.write.parquet(f"{self.path}/{folder}")
        count = self.spark.read.schema(struct).parquet(f"{self.path}/{folder}").count()
        return Layer(folder, count, tuple(lacking(layers, struct)))

    def _write_placed(self, rows: DataFrame, folder: str) -> None:
        placed = rows.withColumn(BATCH, F.lit(0)).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        placed = placed.repartition(self.buckets, *self.keys)
        write_bucketed(placed, f"{self.path}/{folder.split('/')[0]}", self.keys, self.buckets)

    def _written(self, folder: str) -> dict[int, int]:
        """Rows by bucket in a folder; at most one row per bucket."""
        path = f"{self.path}/{folder}"
        if not files.exists(self.spark, path):
            return {}
        schema = self.spec.struct().add(BUCKET, T.IntegerType())
        counted = self.spark.read.schema(schema).parquet(path).groupBy(BUCKET).count()
        return {r[BUCKET]: r["count"] for r in counted.collect()}

    def _prepare(self, staged: StagedDelta, batch: int) -> None:
        """What a batch needs before it can appear. Its files are written already: nothing of the target is read."""

    def _with_batch(self, staged: StagedDelta, batch: int, version: Version) -> Version:
        """The version that holds a batch, too."""
        incoming = staged.counts[batch]
        folder = staged.batch_path(batch)[len(self.path) + 1 :]
        if staged.bucketed and not version.layers and not any(staged.is_other(f) for b in incoming for f, _ in version.live.get(b, [])):
            live = dict(version.live)
            for b, rows in incoming.items():
                live[b] = [*live.get(b, []), (folder, rows)]
            return version.with_live(live)
        return version.with_layer(Layer(folder, sum(incoming.values()), staged.absent))

    def _into_buckets(self, folder: str, incoming: dict[int, int], current: Live) -> Live:
        """Add a folder of bucketed rows whose keys replace the same keys in the buckets.

        Only folders of a bucket that hold such a key are rewritten, and of those only the rows that
        survive; the new folder itself becomes part of the table. With new keys only, nothing is.
        """
        live = dict(current)
        occupied = [b for b in incoming if live.get(b)]
        delta = self.spark.read.schema(self.spec.struct()).parquet(f"{self.path}/{folder}")
        keys = delta.select(*self.keys)
        if occupied and len(self.keys) == len(self.spec.names):
            return self._insert_new(keys, live, occupied)
        if occupied:
            with self._bucketed(live, occupied) as base:
                found = base.select(*self.keys, BUCKET, FOLDER).join(keys, list(self.keys), "left_semi")
                # At most one row per bucket and folder.
                hits = {(r[BUCKET], r[FOLDER]): r["count"] for r in found.groupBy(BUCKET, FOLDER).count().collect()}
            rewrite: Live = {}
            for b in occupied:
                parts = [p for p in live[b] if hits.get((b, p[0]))]
                if parts:
                    rewrite[b] = parts
            kept = {b: sum(rows - hits.get((b, f), 0) for f, rows in parts) for b, parts in rewrite.items()}
            kept_folder = self._write_kept({b: rewrite[b] for b, rows in kept.items() if rows}, keys)
            for b, parts in rewrite.items():
                rest = [p for p in live[b] if p not in parts]
                live[b] = [*rest, (kept_folder, kept[b])] if kept[b] else rest
        for b, rows in incoming.items():
            live[b] = [*live.get(b, []), (folder, rows)]
        return live

    def _write_kept(self, parts: Live, keys: DataFrame) -> str:
        """The rows of some folders whose key is not in the delta, in a new folder."""
        run = uuid.uuid4().hex
        if parts:
            with self._bucketed(parts, parts) as base:
                kept = base.drop(FOLDER).join(keys, list(self.keys), "left_anti").withColumn(BATCH, F.lit(0))
                write_bucketed(kept, f"{self.path}/{run}", self.keys, self.buckets)
        return f"{run}/{BATCH}=0"

    def _insert_new(self, keys: DataFrame, live: Live, occupied: list[int]) -> Live:
        """A table of key columns only has nothing to overwrite: add the keys it does not hold."""
        folder = f"{uuid.uuid4().hex}/{BATCH}=0"
        with self._bucketed(live, occupied) as base:
            self._write_placed(keys.join(base.select(*self.keys), list(self.keys), "left_anti"), folder)
        for bucket, rows in self._written(folder).items():
            live[bucket] = [*live.get(bucket, []), (folder, rows)]
        return live

    def _commit(self, following: Version, source: str | None = None, mark: Mark | None = None) -> None:
        """Publish the rows, and the watermark if one is given, together."""
        if source is not None and mark is not None:
            following = following.with_mark(source, self.spec.table, mark)
        versions.publish(self.spark, self.path, following)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders no one of the last ``keep`` versions needs.

        Frames read from older versions, and a load in progress, must be over.
        """
        published = versions.published(self.spark, self.path)
        kept = published[-max(keep, 1) :]
        needed = {run for name in kept for run in versions.load(self.spark, self.path, name).runs}
        stale = [n for n in files.names(self.spark, self.path) if n not in needed and n[0] not in "_."]
        for name in stale:
            files.delete_tree(self.spark, f"{self.path}/{name}")
        for name in published[: -len(kept)]:
            files.delete_tree(self.spark, f"{self.path}/_versions/{name}")
        return stale


def append_rows(df: DataFrame, path: str, only_if_empty: bool = False) -> bool:
    """Append to a plain Parquet table without a key; optionally only while it holds no row."""
    spark = df.sparkSession
    if only_if_empty and files.exists(spark, path):
        if not spark.read.schema(df.schema).parquet(path).isEmpty():
            return False
    df.write.mode("append").parquet(path)
    return True
