"""The catalogue entry of a database table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.spec import ColumnSpec, TargetSpec


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def catalog_query(table: str, schema: str = "public") -> str:
    """The columns of one table as a query for the database itself."""
    return (
        "SELECT column_name, data_type, is_nullable, column_default, ordinal_position, "
        "numeric_precision, numeric_scale "
        "FROM information_schema.columns "
        f"WHERE table_schema = {quoted(schema)} AND table_name = {quoted(table)}"
    )


def read_catalog(read: Callable[[str], DataFrame], table: str, schema: str = "public") -> TargetSpec | None:
    """The catalogue entry, or None if the table is not there. ``read`` runs a query at the database."""
    name = F.lower("data_type")
    sized = F.when(
        (name == "numeric") & F.col("numeric_precision").isNotNull(),
        F.format_string("numeric(%d,%d)", "numeric_precision", "numeric_scale"),
    )
    rows = (
        read(catalog_query(table, schema))
        .select(
            "column_name",
            F.coalesce(sized, name).alias("data_type"),
            (F.upper("is_nullable") == "YES").alias("is_nullable"),
            "column_default",
            "ordinal_position",
        )
        .orderBy("ordinal_position")
        .collect()
    )
    if not rows:
        return None
    columns = tuple(ColumnSpec(r[0], r[1], r[2], r[3]) for r in rows)
    return TargetSpec(table, columns, schema)
