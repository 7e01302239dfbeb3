"""

Tables a query syncs into lie below the shared folder of the session (``spark.checkpoint.dir``) and
outlive the returned frame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import files
from tablesync.frames import local_frame
from tablesync.functions import with_defaults, with_generated
from tablesync.operators import (
    SchemaValidationError,
    assign_chunks,
    chunk_report,
    count_since,
    differences,
    differing_buckets,
    first_chunk,
    high_watermark,
    null_counts,
    reconcile,
    sample_rows,
    summarize,
    type_matrix,
    validate,
)
from tablesync.plans import run_many, run_sync
from tablesync.sinks import BucketedTable, WatermarkStore, suggest_buckets
from tablesync.sinks.layers import FAN
from tablesync.sinks.audit import AuditTable, RunResult
from tablesync.sources import TableSource
from tablesync.spec import ColumnSpec, SyncConfig, TableConfig, TargetSpec
from tablesync.streaming import sync_available_now

try:
    import corpus_pipeline
    from tablesync.llm import registry
except ImportError:  # the training-data operators are an optional part
    TRAINING_DATA_QUERIES, TRAINING_DATA_SQL = {}, {}
else:
    TRAINING_DATA_QUERIES = {query.__name__: query for query in registry.QUERIES} | {"pipeline": corpus_pipeline.run}
    TRAINING_DATA_SQL = registry.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

SMOKE_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


# -- inputs -----------------------------------------------------------------------------------


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders")


def _versioned(df: DataFrame, value: str) -> DataFrame:
    """Add a binary row version that decodes to the given number."""
    return df.withColumn("rv", F.unhex(F.lpad(F.hex(F.expr(value)), 16, "0")))


def _target(
    spark: SparkSession, sf_dir: str, name: str, like: DataFrame | TargetSpec, keys: list[str], cls=BucketedTable
) -> BucketedTable:
    """A new, empty target with the columns of a frame, sized for the source table."""
    spec = like if isinstance(like, TargetSpec) else TargetSpec.from_frame(name, like)
    buckets = suggest_buckets(spark, _path(sf_dir, name))
    return cls.create(spark, files.scratch(spark, name), spec, keys, buckets)


def _status(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderstatus", F.lit("U"))


# -- sources ----------------------------------------------------------------------------------


def src_full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TableSource(_orders(spark, sf_dir)).by_timestamp("o_orderdate")


def src_incremental_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TableSource(_orders(spark, sf_dir)).by_timestamp("o_orderdate", dt.datetime(2000, 12, 1))


def src_incremental_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = dt.datetime(2024, 1, 25, 0, 15, 9, 245145)
    return TableSource(_read(spark, sf_dir, "events")).by_timestamp("ts", low)


def src_rowversion_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = TableSource(_versioned(_orders(spark, sf_dir), "o_orderkey + 1000"))
    return source.by_rowversion("rv").drop("rv")


def src_rowversion_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = TableSource(_versioned(_orders(spark, sf_dir), "o_orderkey + 1000"))
    return source.by_rowversion("rv", 1500).drop("rv")


def src_tie_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows at a stored watermark: those that share it are not read again."""
    orders, mark = _orders(spark, sf_dir), F.lit("1996-09-17").cast("timestamp_ntz")
    read = TableSource(orders).by_timestamp("o_orderdate", dt.datetime(1996, 9, 17)).select("o_orderkey", F.lit(1).alias("r"))
    place = F.when(F.col("o_orderdate") > mark, "above").when(F.col("o_orderdate") == mark, "tied").otherwise("below")
    marked = orders.withColumn("place", place).join(read, "o_orderkey", "left")
    return marked.groupBy("place").agg(F.count("*").alias("n"), F.count("r").alias("n_read"))


def src_null_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("w")
    )
    source = TableSource(rows)

    def tally(run: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(run).alias("run"), F.count("*").alias("n"), F.count_if(F.col("w").isNull()).alias("null_w")
        )

    full = tally("full", source.by_timestamp("w", high=source.high("w")))
    return full.unionByName(tally("incremental", source.by_timestamp("w", dt.datetime(1998, 1, 1))))


def src_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue entry of a table, with the NULLs each column really holds."""
    orders = _orders(spark, sf_dir)
    catalog = TargetSpec.from_frame("orders", orders).catalog(spark)
    return catalog.join(null_counts(orders, orders.columns), "column_name").select(
        "column_name", "ordinal_position", "is_nullable", "nulls"
    )


# -- projections and aggregates ---------------------------------------------------------------


def prj_generated_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    expression = "CAST(l_quantity AS DECIMAL(6,0)) * CAST(l_extendedprice AS DECIMAL(12,2))"
    rows = with_generated(_read(spark, sf_dir, "lineitem"), "total", expression, "decimal(14,2)")
    return rows.select("l_orderkey", "l_linenumber", "total")


def prj_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    spec = TargetSpec(
        "customer",
        (
            ColumnSpec("c_custkey", "bigint", nullable=False),
            ColumnSpec("c_name", "text"),
            ColumnSpec("activo", "integer", default="1"),
            ColumnSpec("estado", "text", default="'pendiente'"),
        ),
    )
    return with_defaults(rows, spec)


def agg_count_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_since(_orders(spark, sf_dir), "o_orderdate", dt.datetime(1996, 9, 17))


def wm_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)

    def high(name: str, df: DataFrame, column: str) -> DataFrame:
        return high_watermark(df, column).select(F.lit(name).alias("table_name"), F.col("high").alias("last_value"))

    return (
        high("orders", orders, "o_orderdate")
        .unionByName(high("events", _read(spark, sf_dir, "events"), "ts"))
        .unionByName(high("lineitem", _read(spark, sf_dir, "lineitem"), "l_shipdate"))
        .unionByName(high("empty", orders.filter("o_orderkey < 0"), "o_orderdate"))
    )


def wm_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = WatermarkStore(spark, files.scratch(spark, "watermarks"))
    events = _read(spark, sf_dir, "events").agg(F.max("ts"), F.max("event_id") + 1000).first()
    customers = _read(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()
    store.update_timestamp("orders", TableSource(_orders(spark, sf_dir)).high("o_orderdate"))
    store.update_timestamp("events", events[0])
    store.update_rowversion("events", events[1])
    store.update_rowversion("customer", customers[0])
    return store.read().select("table_name", "last_value", "last_rowver")


def wm_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that are set twice, and the row version beside the timestamp."""
    store = WatermarkStore(spark, files.scratch(spark, "watermarks"))
    orders = _orders(spark, sf_dir).agg(F.min("o_orderdate"), F.max("o_orderdate"), F.max("o_orderkey")).first()
    store.update_timestamp("orders", orders[0])
    store.update_rowversion("orders", 1)
    store.update_timestamp("orders", orders[1])
    store.update_rowversion("orders", orders[2])
    rows = [(name, store.get_last_timestamp(name), store.get_last_rowversion(name)) for name in ("orders", "nothing")]
    return local_frame(spark, rows, "table_name string, last_value timestamp_ntz, last_rowver bigint")


def wm_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = WatermarkStore(spark, files.scratch(spark, "watermarks"))
    store.update_timestamp("orders", TableSource(_orders(spark, sf_dir)).high("o_orderdate"))
    rows = [("known", store.get_last_timestamp("orders")), ("missing", store.get_last_timestamp("nothing"))]
    return local_frame(spark, rows, "lookup string, last_value timestamp_ntz")


# -- chunks and samples -----------------------------------------------------------------------


def chunk_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = TableSource(_orders(spark, sf_dir)).by_timestamp("o_orderdate", dt.datetime(1999, 1, 1))
    return chunk_report(delta, 1000)


def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return assign_chunks(rows, "o_orderdate", ["o_orderkey"], 1000).select("o_orderkey", "chunk")


def chunk_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return first_chunk(rows, "o_orderdate", ["o_orderkey"], 1000)


def sort_sample_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(_orders(spark, sf_dir).select("o_orderkey"), 200, ["o_orderkey"])


# -- validation -------------------------------------------------------------------------------

BASE_COLUMNS = (
    ColumnSpec("o_orderkey", "bigint", nullable=False),
    ColumnSpec("o_custkey", "bigint"),
    ColumnSpec("o_orderstatus", "text"),
    ColumnSpec("o_totalprice", "double precision"),
    ColumnSpec("o_orderdate", "timestamp with time zone"),
    ColumnSpec("o_orderpriority", "text"),
)


def _base(**changed: ColumnSpec | None) -> TargetSpec:
    """The base target with columns replaced, added or (None) left out."""
    columns = {c.name: c for c in BASE_COLUMNS} | changed
    return TargetSpec("orders", tuple(c for c in columns.values() if c is not None))


EXTRA = _base(o_orderpriority=None)
MISMATCH = _base(
    o_orderstatus=ColumnSpec("o_orderstatus", "integer"), o_totalprice=ColumnSpec("o_totalprice", "integer")
)


def _issues(df: DataFrame, spec: TargetSpec) -> DataFrame:
    """What is wrong, with the number of rows that the check is about."""
    return validate(df, spec).select("severity", "column_name", "kind", F.lit(df.count()).alias("n_rows"))


def val_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _base(
        created_by=ColumnSpec("created_by", "text", nullable=False),
        note=ColumnSpec("note", "text"),
        loaded_at=ColumnSpec("loaded_at", "timestamp with time zone", nullable=False, default="now()"),
    )
    return _issues(_orders(spark, sf_dir), spec)


def val_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(_orders(spark, sf_dir), EXTRA)


def val_type_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(_orders(spark, sf_dir), MISMATCH)


def val_nullable_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus"))
    )
    spec = _base(o_orderstatus=ColumnSpec("o_orderstatus", "text", nullable=False))
    return validate(rows, spec).select("column_name", "kind", "nulls")


def val_table_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two syncs of one source: the target that does not exist fails before any row is loaded."""
    orders = _orders(spark, sf_dir)
    present = _target(spark, sf_dir, "orders", orders, ["o_orderkey"])
    targets = {"orders": present, "nowhere": None}
    tables = [TableConfig("orders", "o_orderdate", ("o_orderkey",), target_table=name) for name in targets]

    def run(table: TableConfig) -> RunResult:
        return run_sync(TableSource(orders), targets[table.target], table)

    results = run_many(spark, tables, run)
    kind = F.regexp_extract("error", r"\[(\w+)\]", 1)
    return results.select("target_table", "status", F.coalesce(kind, F.lit("")).alias("kind"), F.col("total_rows").alias("n"))


def val_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    cases = {"ok": EXTRA, "bad": MISMATCH}
    frames = [
        summarize(validate(orders, spec)).select(F.lit(case).alias("case_name"), "summary", F.lit(orders.count()).alias("n_rows"))
        for case, spec in cases.items()
    ]
    return frames[0].unionByName(frames[1])


TARGET_TYPES = (
    "smallint", "integer", "bigint", "numeric", "real", "double precision", "character varying", "text",
    "uuid", "jsonb", "boolean", "bytea", "date", "time without time zone", "timestamp with time zone",
    "interval", "array", "user-defined", "int8range", "daterange",
)


def val_type_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of three tables against every target type, with the values that would go there."""
    frames = []
    for name in ("orders", "customer", "lineitem"):
        rows = _read(spark, sf_dir, name)
        values = [
            F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_values")) for c in rows.columns
        ]
        held = rows.agg(F.array(*values).alias("held")).select(F.inline("held"))
        matrix = type_matrix(spark, {f.name: f.dataType for f in rows.schema}, TARGET_TYPES)
        frames.append(matrix.withColumnRenamed("spark_type", "column_name").join(held, "column_name"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# -- upserts ----------------------------------------------------------------------------------


def ups_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even keys are there; odd keys are new, and every seventh key changes."""
    orders = _orders(spark, sf_dir)
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"])
    table.upsert(orders.filter("o_orderkey % 2 = 0"))
    changed = F.when(F.col("o_orderkey") % 7 == 0, F.lit("U")).otherwise(F.col("o_orderstatus"))
    table.upsert(orders.filter("o_orderkey % 2 = 1 or o_orderkey % 7 = 0").withColumn("o_orderstatus", changed))
    return table.read()


def ups_composite_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    table = _target(spark, sf_dir, "lineitem", rows, ["l_orderkey", "l_linenumber"])
    table.upsert(rows.filter("l_orderkey % 2 = 0").withColumn("l_quantity", F.lit(-1.0)), order)
    table.upsert(rows, order)
    return table.read()


def ups_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    table = _target(spark, sf_dir, "events", rows, ["user_id"])
    table.upsert(rows, ["ts", "event_id"])
    return table.read()


def ups_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    spec = TargetSpec(
        "orders",
        (
            ColumnSpec("o_orderkey", "bigint", nullable=False),
            ColumnSpec("o_custkey", "bigint"),
            ColumnSpec("o_orderstatus", "text"),
            ColumnSpec("o_totalprice", "double precision", default="0"),
        ),
    )
    table = _target(spark, sf_dir, "orders", spec, ["o_orderkey"])
    table.upsert(orders.filter("o_orderkey % 2 = 0"))
    table.upsert(orders.filter("o_orderkey % 2 = 1").drop("o_totalprice"))
    table.upsert(_status(orders.filter("o_orderkey % 7 = 0").select("o_orderkey")))
    return table.read()


MANY_LOADS = 20


def ups_many_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty loads, each with some keys of its own and some that others bring, too, every third without a column: few layers."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"])
    for load in range(MANY_LOADS):
        some = orders.filter(f"o_orderkey % {MANY_LOADS} = {load} OR o_orderkey % 7 = {load} % 7")
        some = some.withColumn("o_custkey", F.lit(load).cast("bigint"))
        table.upsert(some.drop("o_orderstatus") if load % 3 == 2 else some.withColumn("o_orderstatus", F.lit(f"s{load}")))
    layers = table.version().layers
    few = len(layers) <= (FAN - 1) * (max(layer.tier for layer in layers) + 1)
    return table.read().withColumn("few_layers", F.lit(few))


def ups_sparse_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that bring one column each, some values NULL: the last one given decides, column by column, before and after
    the layers are compacted."""
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    columns = tuple(ColumnSpec(c, t, default=d) for c, t, d in (
        ("o_orderkey", "bigint", None), ("o_custkey", "bigint", "-1"), ("o_orderstatus", "text", "'new'"), ("o_totalprice", "double precision", None),
    ))
    table = _target(spark, sf_dir, "orders", TargetSpec("orders", columns), ["o_orderkey"])
    table.upsert(rows.filter("o_orderkey % 2 = 0"))
    table.upsert(rows.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit(3).cast("bigint").alias("o_custkey")))
    table.upsert(rows.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus")))
    table.upsert(rows.filter("o_orderkey % 7 = 0").select("o_orderkey", "o_totalprice"))
    layered = table.read().withColumn("state", F.lit("layered"))
    table.compact()
    return layered.unionByName(table.read().withColumn("state", F.lit("compacted")))


def ups_stale_overwrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    table = _target(spark, sf_dir, "orders", rows, ["o_orderkey"])
    table.upsert(rows, ["o_orderdate"])
    older = rows.filter("o_orderkey % 5 = 0").withColumn("o_orderdate", F.expr("o_orderdate - INTERVAL 10 YEAR"))
    table.upsert(older, ["o_orderdate"])
    return table.read()


def ups_idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    table = _target(spark, sf_dir, "orders", rows, ["o_orderkey"])
    table.upsert(rows)
    delta = _status(rows.filter("o_orderkey % 7 = 0"))
    table.upsert(delta)
    table.upsert(delta)
    return table.read()


def ups_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey")
    table = _target(spark, sf_dir, "orders", rows, ["o_orderkey"])
    table.upsert(rows.filter("o_orderkey % 2 = 0"))
    table.upsert(rows)
    return table.read()


def ups_update_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice")
    table = _target(spark, sf_dir, "orders", rows, ["o_orderkey"])
    table.upsert(rows)
    sampled = sample_rows(rows.select("o_orderkey"), 200, ["o_orderkey"])
    table.upsert(_status(sampled).withColumn("o_totalprice", F.lit(99.5)))
    return table.read()


def ups_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    table = _target(spark, sf_dir, "orders", rows, ["o_orderkey"])
    for some in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1", "o_orderkey % 4 = 0"):
        table.append(rows.filter(some))
    return table.read()


class _FirstBatchFails(BucketedTable):
    """A target whose batch 0 cannot be written."""

    def _prepare(self, staged, batch):
        if batch == 0:
            raise OSError("injected: no space left")


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"], _FirstBatchFails)
    config = SyncConfig(retry_attempts=2, retry_wait_min=0.01, retry_wait_max=0.02)
    staged = table.stage(orders, ["o_orderdate"], 3, F.col("o_orderkey") % 3)
    summary = table.load(staged, config=config)
    row = ("orders", summary.total_rows, summary.chunks_ok, summary.chunks_failed, summary.status)
    return local_frame(
        spark, [row], "table_name string, total_rows bigint, chunks_ok bigint, chunks_failed bigint, status string"
    )


class _FailsOnce(BucketedTable):
    """A target whose first write fails."""

    failed = False

    def _prepare(self, staged, batch):
        if not self.failed:
            self.failed = True
            raise OSError("injected: connection reset")


def ups_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second attempt of a batch loads it."""
    orders = _orders(spark, sf_dir)
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"], _FailsOnce)
    config = SyncConfig(retry_attempts=2, retry_wait_min=0.01, retry_wait_max=0.02)
    summary = table.upsert(orders, ["o_orderdate"], config=config)
    return table.read().select("o_orderkey", F.lit(summary.status).alias("status"))


def ddl_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating an existing table leaves it as it is; recreating empties it."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"])
    table.upsert(orders)
    rows = []
    for step, anew in (("create", False), ("recreate", True)):
        again = BucketedTable.create(spark, table.path, table.spec, table.keys, table.buckets, recreate=anew)
        rows.append((step, again.read().count()))
    return local_frame(spark, rows, "step string, n bigint")


# -- runs -------------------------------------------------------------------------------------

ORDERS_SYNC = TableConfig("orders", "o_orderdate", ("o_orderkey",))
RUN_ENDS = ("1997-01-01", "1999-06-01", None)


def _three_runs(spark: SparkSession, sf_dir: str) -> tuple[BucketedTable, list[RunResult]]:
    """The source grows twice between the runs."""
    orders = _orders(spark, sf_dir)
    table = _target(spark, sf_dir, "orders", orders, ["o_orderkey"])
    results = []
    for end in RUN_ENDS:
        seen = orders if end is None else orders.filter(F.col("o_orderdate") <= F.lit(end).cast("timestamp_ntz"))
        results.append(run_sync(TableSource(seen), table, ORDERS_SYNC))
    return table, results


def pipe_three_runs_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, results = _three_runs(spark, sf_dir)
    rows = [(i, r.low, r.high, r.total_rows) for i, r in enumerate(results, start=1)]
    return local_frame(spark, rows, "run int, low timestamp_ntz, high timestamp_ntz, n bigint")


def pipe_three_runs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _three_runs(spark, sf_dir)
    return table.read()


def pipe_rowversion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _versioned(_orders(spark, sf_dir), "o_orderkey + 1000")
    table = _target(spark, sf_dir, "orders", orders.drop("rv"), ["o_orderkey"])
    config = TableConfig("orders", "rv", ("o_orderkey",), mode="rowversion")
    rows = []
    for run, seen in enumerate((orders.filter("o_orderkey < 500"), orders, orders), start=1):
        result = run_sync(TableSource(seen), table, config)
        rows.append((run, table.mark("orders").last_rowver, result.total_rows))
    return local_frame(spark, rows, "run int, last_rowver bigint, n bigint")


def pipe_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _three_runs(spark, sf_dir)
    return reconcile(_orders(spark, sf_dir), table.read(), "o_orderdate")


def pipe_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded target equals its source. With rows changed, lost and added, the keys that differ are found."""
    table, _ = _three_runs(spark, sf_dir)
    orders, loaded = _orders(spark, sf_dir), table.read()
    equal = differing_buckets(orders, loaded, ["o_orderkey"]).isEmpty()
    status = F.when(F.col("o_orderkey") % 1000 == 7, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
    added = loaded.filter("o_orderkey % 3000 = 5").withColumn("o_orderkey", -F.col("o_orderkey"))
    spoiled = loaded.filter("o_orderkey % 1500 <> 11").withColumn("o_orderstatus", status).unionByName(added)
    return differences(orders, spoiled, ["o_orderkey"]).withColumn("equal_before", F.lit(equal))


def pipe_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {
        "orders": _orders(spark, sf_dir),
        "events": _read(spark, sf_dir, "events"),
        "customer": _versioned(_read(spark, sf_dir, "customer"), "c_custkey"),
    }
    tables = TableConfig.from_json(
        """[
        {"table": "orders", "watermark_col": "o_orderdate", "conflict_columns": ["o_orderkey"]},
        {"table": "events", "watermark_col": "ts", "conflict_columns": ["event_id"]},
        {"table": "customer", "watermark_col": "rv", "conflict_columns": ["c_custkey"], "mode": "rowversion"}
        ]"""
    )

    def run(table: TableConfig) -> RunResult:
        rows = sources[table.table]
        target = _target(spark, sf_dir, table.table, rows.drop("rv"), list(table.conflict_columns))
        return run_sync(TableSource(rows), target, table)

    return run_many(spark, tables, run).select("table_name", "mode", F.col("total_rows").alias("n"), "status")


def pipe_multi_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables side by side, the third into a target that does not exist; what the audit table holds of them."""
    audit = AuditTable(spark, files.scratch(spark, "audit"))
    columns = {"orders": ("o_orderdate", "o_orderkey"), "events": ("ts", "event_id"), "lineitem": ("l_shipdate", "l_orderkey")}

    def run(table: TableConfig) -> RunResult:
        rows = _read(spark, sf_dir, table.table)
        known = table.table != "lineitem"
        target = _target(spark, sf_dir, table.table, rows, list(table.conflict_columns)) if known else None
        return run_sync(TableSource(rows), target, table, audit=audit)

    run_many(spark, [TableConfig(name, mark, (key,)) for name, (mark, key) in columns.items()], run)
    return audit.read().select("table_name", F.col("total_rows").alias("n"), "high", "status")


def pipe_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose rows break a NOT NULL rule changes neither the rows nor the mark, and the next one goes on."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_orderdate")
    spec = TargetSpec.from_frame("orders", orders, ["o_orderkey", "o_orderstatus"])
    table = _target(spark, sf_dir, "orders", spec, ["o_orderkey"])
    early = orders.filter(F.col("o_orderdate") <= F.lit("1997-01-01").cast("timestamp_ntz"))
    broken = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")))
    rows = []
    for step, source in (("early", early), ("broken", broken), ("repaired", orders)):
        try:
            status = run_sync(TableSource(source), table, ORDERS_SYNC).status
        except SchemaValidationError:
            status = "failed"
        rows.append((step, status, table.read().count(), table.mark("orders").last_value))
    return local_frame(spark, rows, "step string, status string, n bigint, mark timestamp_ntz")


# -- streams ----------------------------------------------------------------------------------


def _arrive(rows: DataFrame, folder: str) -> None:
    """Add rows to a folder as four files, or as one per task where that is more."""
    per_file = max(-(-rows.count() // 4), 1)
    rows.write.mode("append").option("maxRecordsPerFile", per_file).parquet(folder)


def _stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The files of a folder as a stream of about four micro-batches."""
    per_batch = max(files.total_bytes(spark, folder) // 4, 1)
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(per_batch)).parquet(folder)


def str_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    folder = files.scratch(spark, "arrivals")
    _arrive(events, folder)
    table = _target(spark, sf_dir, "events", events, ["event_id"])
    sync_available_now(_stream(spark, folder, events.schema), table, files.scratch(spark, "progress"), ["ts"])
    return table.read()


def str_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    folder, progress = files.scratch(spark, "arrivals"), files.scratch(spark, "progress")
    table = _target(spark, sf_dir, "events", events, ["event_id"])
    rows = []
    for start, arrived in enumerate(("event_id % 4 <> 3", "event_id % 4 = 3"), start=1):
        _arrive(events.filter(arrived), folder)
        summary = sync_available_now(_stream(spark, folder, events.schema), table, progress, ["ts"])
        rows.append((start, summary.total_rows))
    return local_frame(spark, rows, "start int, n bigint")


class _DiesOnce(BucketedTable):
    """A target whose process ends after the second commit, before the stream can record the batch."""

    commits = 0

    def load(self, *args, **options):
        summary = super().load(*args, **options)
        self.commits += 1
        if self.commits == 2:
            raise OSError("injected: lost after the commit")
        return summary


def str_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was committed but not recorded comes again with the next start: it is left out."""
    events = _read(spark, sf_dir, "events")
    folder, progress = files.scratch(spark, "arrivals"), files.scratch(spark, "progress")
    _arrive(events, folder)
    table = _target(spark, sf_dir, "events", events, ["event_id"], _DiesOnce)
    stream = _stream(spark, folder, events.schema)
    failed = 0
    try:
        sync_available_now(stream, table, progress, ["ts"])
    except StreamingQueryException:
        failed = 1
    before = table.version()
    stored = before.bucket_rows + before.layer_rows
    resumed = sync_available_now(stream, table, progress, ["ts"]).total_rows
    return table.read().agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.lit(stored + resumed).cast("bigint").alias("n_loaded"), F.lit(failed).alias("failed_starts")
    )


# -- contract ---------------------------------------------------------------------------------

QUERIES: tuple[Query, ...] = (
    src_full_snapshot,
    src_incremental_timestamp,
    src_incremental_micros,
    src_rowversion_full,
    src_rowversion_incremental,
    src_tie_excluded,
    src_null_watermark,
    src_catalog,
    prj_generated_total,
    prj_defaults,
    agg_count_since,
    wm_high,
    wm_upsert,
    wm_slots,
    wm_lookup,
    chunk_progress,
    chunk_assign,
    chunk_first,
    sort_sample_topk,
    val_missing,
    val_extra,
    val_type_mismatch,
    val_nullable_violation,
    val_table_not_found,
    val_summary,
    val_type_matrix,
    ups_basic,
    ups_composite_last_wins,
    ups_dedup_latest,
    ups_partial_columns,
    ups_many_layers,
    ups_sparse_layers,
    ups_stale_overwrites,
    ups_idempotent_replay,
    ups_key_only,
    ups_update_sample,
    ups_append,
    load_summary,
    ups_retry,
    ddl_recreate,
    pipe_multi_audit,
    pipe_failed_run,
    pipe_three_runs_audit,
    pipe_three_runs_target,
    pipe_rowversion_runs,
    pipe_reconcile,
    pipe_compare,
    pipe_multi_table,
    str_available_now,
    str_resume,
    str_replay,
)

ORACLE = """
-- name: src_full_snapshot
SELECT * FROM orders
-- name: src_incremental_timestamp
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-12-01'
-- name: src_incremental_micros
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-25 00:15:09.245145'
-- name: src_rowversion_full
SELECT *, o_orderkey + 1000 AS __rowver FROM orders
-- name: src_rowversion_incremental
SELECT *, o_orderkey + 1000 AS __rowver FROM orders WHERE o_orderkey + 1000 > 1500
-- name: src_tie_excluded
SELECT CASE WHEN o_orderdate > TIMESTAMP '1996-09-17' THEN 'above' WHEN o_orderdate = TIMESTAMP '1996-09-17' THEN 'tied'
            ELSE 'below' END AS place, count(*) AS n, count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1996-09-17') AS n_read
FROM orders GROUP BY 1
-- name: src_null_watermark
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS w FROM orders)
SELECT 'full' AS run, count(*) AS n, count(*) - count(w) AS null_w FROM s
UNION ALL SELECT 'incremental', count(*), count(*) - count(w) FROM s WHERE w > TIMESTAMP '1998-01-01'
-- name: src_catalog
WITH c AS (
  SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM orders
  UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM orders
  UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders
  UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM orders)
SELECT DISTINCT i.column_name, CAST(i.ordinal_position AS BIGINT) AS ordinal_position,
       i.is_nullable = 'YES' AS is_nullable, c.nulls
FROM information_schema.columns i JOIN c ON i.column_name = c.column_name WHERE i.table_name = 'orders'
-- name: prj_generated_total
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(6,0)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS total
FROM lineitem
-- name: prj_defaults
SELECT c_custkey, c_name, 1 AS activo, 'pendiente' AS estado FROM customer
-- name: agg_count_since
SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-09-17'
-- name: wm_high
SELECT 'orders' AS table_name, max(o_orderdate) AS last_value FROM orders
UNION ALL SELECT 'events', max(ts) FROM events
UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
UNION ALL SELECT 'empty', max(o_orderdate) FROM orders WHERE o_orderkey < 0
-- name: wm_upsert
SELECT 'orders' AS table_name, max(o_orderdate) AS last_value, CAST(NULL AS BIGINT) AS last_rowver FROM orders
UNION ALL SELECT 'events', max(ts), max(event_id) + 1000 FROM events
UNION ALL SELECT 'customer', CAST(NULL AS TIMESTAMP), max(c_custkey) FROM customer
-- name: wm_slots
SELECT 'orders' AS table_name, max(o_orderdate) AS last_value, max(o_orderkey) AS last_rowver FROM orders
UNION ALL SELECT 'nothing', CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT)
-- name: wm_lookup
SELECT 'known' AS lookup, max(o_orderdate) AS last_value FROM orders
UNION ALL SELECT 'missing', CAST(NULL AS TIMESTAMP)
-- name: chunk_progress
WITH c AS (SELECT (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS chunk
           FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01')
SELECT chunk, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY chunk) AS BIGINT) AS cumulative,
       chunk = max(chunk) OVER () AS is_final
FROM c GROUP BY chunk
-- name: chunk_assign
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS chunk FROM orders
-- name: chunk_first
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000
-- name: sort_sample_topk
SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 200
-- name: val_missing
SELECT v.*, n_rows FROM (VALUES ('error', 'created_by', 'missing_required'), ('warning', 'note', 'missing_optional'),
  ('warning', 'loaded_at', 'missing_optional')) v(severity, column_name, kind), (SELECT count(*) AS n_rows FROM orders) o
-- name: val_extra
SELECT 'warning' AS severity, 'o_orderpriority' AS column_name, 'extra_column' AS kind, count(*) AS n_rows FROM orders
-- name: val_type_mismatch
SELECT v.*, n_rows FROM (VALUES ('error', 'o_orderstatus', 'type_mismatch'), ('error', 'o_totalprice', 'type_mismatch'))
  v(severity, column_name, kind), (SELECT count(*) AS n_rows FROM orders) o
-- name: val_nullable_violation
SELECT 'o_orderstatus' AS column_name, 'nullable_violation' AS kind, count(*) AS nulls
FROM orders WHERE o_orderkey % 10 = 0
-- name: val_table_not_found
SELECT 'orders' AS target_table, 'success' AS status, '' AS kind, count(*) AS n FROM orders
UNION ALL SELECT 'nowhere', 'failed', 'table_not_found', CAST(0 AS BIGINT)
-- name: val_summary
SELECT 'ok' AS case_name, 'PASS (warnings=1)' AS summary, count(*) AS n_rows FROM orders
UNION ALL SELECT 'bad', 'FAIL — type_mismatch:o_orderstatus; type_mismatch:o_totalprice', count(*) FROM orders
-- name: val_type_matrix
WITH accepted(spark_type, accepts) AS (VALUES
  ('int', ['smallint','integer','bigint','numeric','serial']),
  ('bigint', ['smallint','integer','bigint','numeric','int8','serial','real','float','double']),
  ('double', ['real','float','double','numeric']),
  ('string', ['char','text','varchar','uuid','json','xml']),
  ('timestamp_ntz', ['timestamp','date','time'])),
s AS (
  SELECT 'o_orderkey' AS column_name, 'bigint' AS spark_type, count(o_orderkey) AS n_values FROM orders
  UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
  UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
  UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
  UNION ALL SELECT 'c_custkey', 'bigint', count(c_custkey) FROM customer
  UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer
  UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM customer
  UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer
  UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM customer
  UNION ALL SELECT 'l_orderkey', 'bigint', count(l_orderkey) FROM lineitem
  UNION ALL SELECT 'l_partkey', 'bigint', count(l_partkey) FROM lineitem
  UNION ALL SELECT 'l_suppkey', 'bigint', count(l_suppkey) FROM lineitem
  UNION ALL SELECT 'l_linenumber', 'int', count(l_linenumber) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'double', count(l_quantity) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'double', count(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', 'double', count(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', 'double', count(l_tax) FROM lineitem
  UNION ALL SELECT 'l_returnflag', 'string', count(l_returnflag) FROM lineitem
  UNION ALL SELECT 'l_linestatus', 'string', count(l_linestatus) FROM lineitem
  UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', count(l_shipdate) FROM lineitem),
t(pg_type) AS (VALUES ('smallint'),('integer'),('bigint'),('numeric'),('real'),('double precision'),
  ('character varying'),('text'),('uuid'),('jsonb'),('boolean'),('bytea'),('date'),('time without time zone'),
  ('timestamp with time zone'),('interval'),('array'),('user-defined'),('int8range'),('daterange'))
SELECT column_name, pg_type, len(list_filter(accepts, lambda a: contains(pg_type, a))) > 0 AS compatible, n_values
FROM s JOIN accepted USING (spark_type) CROSS JOIN t
-- name: ups_basic
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders
-- name: ups_composite_last_wins
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
             l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS r FROM lineitem) x
WHERE r = 1
-- name: ups_dedup_latest
SELECT event_id, ts, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) x
WHERE r = 1
-- name: ups_partial_columns
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE 0 END AS o_totalprice
FROM orders
-- name: ups_many_layers
WITH l AS (SELECT o_orderkey, k, k % 3 <> 2 AS given FROM orders, range(20) t(k)
           WHERE o_orderkey % 20 = k OR o_orderkey % 7 = k % 7)
SELECT o_orderkey, max(k) AS o_custkey, 's' || max(k) FILTER (WHERE given) AS o_orderstatus, TRUE AS few_layers
FROM l GROUP BY o_orderkey
-- name: ups_sparse_layers
WITH r AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE -1 END AS o_custkey,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'new' END AS o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0)
SELECT r.*, state FROM r CROSS JOIN (VALUES ('layered'), ('compacted')) s(state)
-- name: ups_stale_overwrites
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate - INTERVAL 10 YEAR ELSE o_orderdate END AS o_orderdate
FROM orders
-- name: ups_idempotent_replay
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM orders
-- name: ups_key_only
SELECT o_orderkey FROM orders
-- name: ups_update_sample
WITH k AS (SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 200)
SELECT o.o_orderkey, CASE WHEN k.o_orderkey IS NOT NULL THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN k.o_orderkey IS NOT NULL THEN 99.5 ELSE o_totalprice END AS o_totalprice
FROM orders o LEFT JOIN k ON o.o_orderkey = k.o_orderkey
-- name: ups_append
SELECT o_orderkey, o_custkey FROM orders
UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 0
-- name: load_summary
SELECT 'orders' AS table_name, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS total_rows,
       CAST(2 AS BIGINT) AS chunks_ok, CAST(1 AS BIGINT) AS chunks_failed, 'partial_failure' AS status
FROM orders
-- name: ups_retry
SELECT o_orderkey, 'success' AS status FROM orders
-- name: ddl_recreate
SELECT 'create' AS step, count(*) AS n FROM orders UNION ALL SELECT 'recreate', CAST(0 AS BIGINT)
-- name: pipe_multi_audit
SELECT 'orders' AS table_name, count(*) AS n, max(o_orderdate) AS high, 'success' AS status FROM orders
UNION ALL SELECT 'events', count(*), max(ts), 'success' FROM events
UNION ALL SELECT 'lineitem', CAST(0 AS BIGINT), CAST(NULL AS TIMESTAMP), 'failed'
-- name: pipe_failed_run
WITH e AS (SELECT count(*) AS n, max(o_orderdate) AS mark FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01')
SELECT 'early' AS step, 'success' AS status, n, mark FROM e
UNION ALL SELECT 'broken', 'failed', n, mark FROM e
UNION ALL SELECT 'repaired', 'success', count(*), max(o_orderdate) FROM orders
-- name: pipe_three_runs_audit
WITH w AS (SELECT max(o_orderdate) FILTER (WHERE o_orderdate <= TIMESTAMP '1997-01-01') AS h1,
                  max(o_orderdate) FILTER (WHERE o_orderdate <= TIMESTAMP '1999-06-01') AS h2,
                  max(o_orderdate) AS h3 FROM orders)
SELECT 1 AS run, CAST(NULL AS TIMESTAMP) AS low, h1 AS high,
       (SELECT count(*) FROM orders WHERE o_orderdate <= h1) AS n FROM w
UNION ALL SELECT 2, h1, h2, (SELECT count(*) FROM orders WHERE o_orderdate > h1 AND o_orderdate <= h2) FROM w
UNION ALL SELECT 3, h2, h3, (SELECT count(*) FROM orders WHERE o_orderdate > h2 AND o_orderdate <= h3) FROM w
-- name: pipe_three_runs_target
SELECT * FROM orders
-- name: pipe_rowversion_runs
SELECT 1 AS run, max(o_orderkey) + 1000 AS last_rowver, count(*) AS n FROM orders WHERE o_orderkey < 500
UNION ALL SELECT 2, max(o_orderkey) + 1000, count(*) FILTER (WHERE o_orderkey >= 500) FROM orders
UNION ALL SELECT 3, max(o_orderkey) + 1000, CAST(0 AS BIGINT) FROM orders
-- name: pipe_reconcile
SELECT 'source' AS side, count(*) AS n, max(o_orderdate) AS max_w FROM orders
UNION ALL SELECT 'target', count(*), max(o_orderdate) FROM orders
-- name: pipe_compare
SELECT o_orderkey, 'changed' AS kind, TRUE AS equal_before FROM orders WHERE o_orderkey % 1000 = 7 AND o_orderkey % 1500 <> 11
UNION ALL SELECT o_orderkey, 'missing', TRUE FROM orders WHERE o_orderkey % 1500 = 11
UNION ALL SELECT -o_orderkey, 'extra', TRUE FROM orders WHERE o_orderkey % 3000 = 5 AND o_orderkey % 1500 <> 11
-- name: pipe_multi_table
SELECT 'orders' AS table_name, 'timestamp' AS mode, count(*) AS n, 'success' AS status FROM orders
UNION ALL SELECT 'events', 'timestamp', count(*), 'success' FROM events
UNION ALL SELECT 'customer', 'rowversion', count(*), 'success' FROM customer
-- name: str_available_now
SELECT * FROM events
-- name: str_resume
SELECT 1 AS start, count(*) FILTER (WHERE event_id % 4 <> 3) AS n FROM events
UNION ALL SELECT 2, count(*) FILTER (WHERE event_id % 4 = 3) FROM events
-- name: str_replay
SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(*) AS n_loaded, 1 AS failed_starts FROM events
"""


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: three incremental runs of one table; the audit of the runs."""
    return pipe_three_runs_audit(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES} | TRAINING_DATA_QUERIES


def oracle_sql() -> dict[str, str]:
    blocks = ORACLE.split("-- name: ")[1:]
    named = (block.split("\n", 1) for block in blocks)
    return {name.strip(): sql.strip() for name, sql in named} | TRAINING_DATA_SQL
