"""Set-up and syncs of a sales and a customer table: decimals, defaults, a computed column."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sync_helpers import rows
from tablesync.frames import local_frame
from tablesync.functions import with_generated
from tablesync.operators import sample_rows
from tablesync.plans import run_sync
from tablesync.sinks import BucketedTable, append_rows
from tablesync.sources import TableSource
from tablesync.sources.jdbc import oracle_columns
from tablesync.spec import ColumnSpec, TableConfig, TargetSpec

SALES = TargetSpec(
    "ventas",
    (
        ColumnSpec("id", "integer", nullable=False),
        ColumnSpec("cliente_id", "integer"),
        ColumnSpec("producto", "text", nullable=False),
        ColumnSpec("cantidad", "integer", default="1"),
        ColumnSpec("precio_unit", "numeric(12,2)", nullable=False),
        ColumnSpec("total", "numeric(14,2)"),
        ColumnSpec("estado", "text"),
        ColumnSpec("updated_at", "timestamp with time zone"),
    ),
)
CUSTOMERS = TargetSpec(
    "clientes",
    (
        ColumnSpec("id", "integer", nullable=False),
        ColumnSpec("nombre", "text", nullable=False),
        ColumnSpec("ciudad", "text"),
        ColumnSpec("email", "text"),
        ColumnSpec("activo", "smallint", default="1"),
        ColumnSpec("updated_at", "timestamp with time zone"),
    ),
)
START = dt.datetime(2024, 1, 1)


def sales(spark, first, last, day):
    """Rows as the source holds them: whole numbers as decimals, the total computed."""
    base = spark.range(first, last).select(
        F.col("id").cast("decimal(10,0)").alias("id"),
        (F.col("id") % 7).cast("decimal(10,0)").alias("cliente_id"),
        F.concat(F.lit("p"), F.col("id") % 5).alias("producto"),
        (F.col("id") % 20 + 1).cast("decimal(6,0)").alias("cantidad"),
        (F.col("id") * 1.25).cast("decimal(12,2)").alias("precio_unit"),
        F.lit("pendiente").alias("estado"),
        F.lit(str(START + dt.timedelta(days=day))).cast("timestamp_ntz").alias("updated_at"),
    )
    return with_generated(base, "total", "cantidad * precio_unit", "decimal(14,2)")


@pytest.fixture
def target(spark, folder):
    return BucketedTable.create(spark, folder, SALES, ["id"], 4)


def test_first_load_then_inserts_and_updates(spark, target):
    config = TableConfig("ventas", "updated_at", ("id",))
    first = oracle_columns(sales(spark, 1, 201, 0))
    assert run_sync(TableSource(first), target, config).total_rows == 200
    touched = sample_rows(first.select("id"), 20, ["id"]).withColumn("touched", F.lit(True))
    changed = first.join(touched, "id", "left").select(
        *[c for c in first.columns if c not in ("estado", "updated_at")],
        F.when(F.col("touched"), F.lit("enviado")).otherwise(F.col("estado")).alias("estado"),
        F.when(F.col("touched"), F.lit(str(START + dt.timedelta(days=1))).cast("timestamp_ntz"))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )
    after = changed.unionByName(oracle_columns(sales(spark, 201, 301, 1)))
    assert run_sync(TableSource(after), target, config).total_rows == 120
    loaded = target.read()
    assert loaded.count() == 300 and loaded.filter("estado = 'enviado'").count() == 20
    assert loaded.schema["precio_unit"].dataType.simpleString() == "decimal(12,2)"
    assert loaded.filter("id = 10").first()["total"] == Decimal("137.50")


def test_decimal_columns_do_not_pass_for_integers(spark, target):
    """A decimal source column is refused by an integer target column, as by the rules of the types."""
    config = TableConfig("ventas", "updated_at", ("id",))
    with pytest.raises(ValueError, match=r"\[type_mismatch\] cantidad: .* \[type_mismatch\] id"):
        run_sync(TableSource(sales(spark, 1, 5, 0)), target, config)


def test_omitted_flag_takes_its_default_and_keeps_its_value(spark, folder):
    target = BucketedTable.create(spark, folder, CUSTOMERS, ["id"], 2)
    target.upsert(local_frame(spark, [(1, "Norden", START), (2, "Ostsee", START)], "id int, nombre string, updated_at timestamp_ntz"))
    assert rows(target.read(), "id", "activo") == [(1, 1), (2, 1)]
    target.upsert(local_frame(spark, [(1, 0)], "id int, activo smallint").withColumn("nombre", F.lit("Norden")))
    target.upsert(local_frame(spark, [(1, "Norden AB")], "id int, nombre string"))
    assert rows(target.read(), "id", "nombre", "activo") == [(1, "Norden AB", 0), (2, "Ostsee", 1)]


def test_rows_go_in_only_while_the_table_is_empty(spark, tmp_path):
    path = str(tmp_path / "clientes")
    frame = local_frame(spark, [(1, "Norden")], "id int, nombre string")
    assert append_rows(frame, path, only_if_empty=True)
    assert not append_rows(frame, path, only_if_empty=True)
    assert spark.read.parquet(path).count() == 1
