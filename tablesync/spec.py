"""Configuration and target descriptions: plain frozen dataclasses, no Spark work."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.frames import local_frame

MODES = ("timestamp", "rowversion")

# Declared column types of a target and the Spark type that stores them.
# Matched on the type name without its parameters.
STORAGE_TYPES = {
    "smallint": T.ShortType(),
    "smallserial": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "serial": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "bigserial": T.LongType(),
    "real": T.FloatType(),
    "float": T.DoubleType(),
    "double precision": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampNTZType(),
    "interval": T.DayTimeIntervalType(),
}


def storage_type(data_type: str) -> T.DataType:
    """Spark type for a declared target type; every text-like type is stored as a string."""
    declared = data_type.strip().lower()
    name = re.sub(r"\s*\([^)]*\)", "", declared)
    if name in ("numeric", "decimal"):
        params = re.search(r"\((\d+)\s*(?:,\s*(\d+))?\)", declared)
        if params is None:
            return T.DecimalType(38, 18)
        return T.DecimalType(int(params.group(1)), int(params.group(2) or 0))
    return STORAGE_TYPES.get(name, T.StringType())


# Declared type written for a Spark type when a target is derived from a frame.
DECLARED_TYPES = {
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "integer",
    "bigint": "bigint",
    "float": "real",
    "double": "double precision",
    "boolean": "boolean",
    "binary": "bytea",
    "date": "date",
    "timestamp": "timestamp with time zone",
    "timestamp_ntz": "timestamp with time zone",
    "interval day to second": "interval",
}


def declared_type(data_type: T.DataType) -> str:
    name = data_type.simpleString()
    if isinstance(data_type, T.DecimalType):
        return f"numeric({data_type.precision},{data_type.scale})"
    return DECLARED_TYPES.get(name, "text")


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a target: its declared type, nullability and default (a SQL expression)."""

    name: str
    data_type: str
    nullable: bool = True
    default: str | None = None


@dataclass(frozen=True)
class TargetSpec:
    """The catalogue entry of a target table."""

    table: str
    columns: tuple[ColumnSpec, ...]
    schema: str = "public"

    CATALOG_SCHEMA = (
        "column_name string, data_type string, is_nullable boolean, "
        "has_default boolean, ordinal_position bigint"
    )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        """Columns that reject NULL."""
        return [c.name for c in self.columns if not c.nullable]

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    def without_defaults(self) -> TargetSpec:
        return replace(self, columns=tuple(replace(c, default=None) for c in self.columns))

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, storage_type(c.data_type)) for c in self.columns])

    def catalog(self, spark: SparkSession) -> DataFrame:
        """The catalogue rows in ordinal order: lower-cased type, nullability and default flags."""
        rows = [
            (c.name, c.data_type.lower(), c.nullable, c.default is not None, i)
            for i, c in enumerate(self.columns, start=1)
        ]
        return local_frame(spark, rows, self.CATALOG_SCHEMA).orderBy("ordinal_position")

    def to_json(self) -> dict[str, Any]:
        return {"table": self.table, "schema": self.schema, "columns": [asdict(c) for c in self.columns]}

    @classmethod
    def from_json(cls, value: Mapping[str, Any]) -> TargetSpec:
        return cls(value["table"], tuple(ColumnSpec(**c) for c in value["columns"]), value["schema"])

    @classmethod
    def from_frame(
        cls, table: str, df: DataFrame, required: Iterable[str] = (), schema: str = "public"
    ) -> TargetSpec:
        """A target with the columns of a frame; the named ones reject NULL."""
        needed = set(required)
        columns = tuple(
            ColumnSpec(f.name, declared_type(f.dataType), f.name not in needed) for f in df.schema
        )
        return cls(table, columns, schema)


@dataclass(frozen=True)
class TableConfig:
    """What to sync: a source table, how its changes are found, and the key of the target."""

    table: str
    watermark_col: str
    conflict_columns: tuple[str, ...]
    mode: str = "timestamp"
    target_table: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "conflict_columns", tuple(self.conflict_columns))

    @property
    def target(self) -> str:
        return self.target_table or self.table

    def check_mode(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"Unknown mode: {self.mode}. Use 'timestamp' or 'rowversion'.")

    @classmethod
    def from_json(cls, text: str) -> list[TableConfig]:
        """The table list as JSON: mode defaults to timestamp, the target name to the source name."""
        return [
            cls(
                table=item["table"],
                watermark_col=item["watermark_col"],
                conflict_columns=tuple(item["conflict_columns"]),
                mode=item.get("mode", "timestamp"),
                target_table=item.get("target_table"),
            )
            for item in json.loads(text or "[]")
        ]


@dataclass(frozen=True)
class Connection:
    """Where a database is. The password stays out of ``repr``."""

    dialect: str
    host: str
    port: int
    database: str
    username: str
    password: str = field(repr=False)


@dataclass(frozen=True)
class SyncConfig:
    """Settings of a run."""

    chunk_size: int = 10_000
    max_workers: int = 4
    batches: int = 1
    retry_attempts: int = 5
    retry_wait_min: float = 2.0
    retry_wait_max: float = 30.0
    retry_multiplier: float = 1.5
    validation_scope: str = "all"
    source: Any = None
    target: Any = None

    def retry_wait(self, attempt: int) -> float:
        """Seconds to wait after the given failed attempt (1, 2, ...)."""
        return min(max(self.retry_multiplier * 2 ** (attempt - 1), self.retry_wait_min), self.retry_wait_max)


def load_config(options: Mapping[str, str]) -> SyncConfig:
    """Settings from a flat mapping of options, such as job arguments."""
    source = Connection(
        options["SOURCE_DIALECT"],
        options["SOURCE_HOST"],
        int(options.get("SOURCE_PORT", 1433)),
        options["SOURCE_DATABASE"],
        options["SOURCE_USER"],
        options["SOURCE_PASSWORD"],
    )
    target = Connection(
        options.get("TARGET_DIALECT", "postgresql"),
        options["TARGET_HOST"],
        int(options.get("TARGET_PORT", 5432)),
        options["TARGET_DATABASE"],
        options["TARGET_USER"],
        options["TARGET_PASSWORD"],
    )
    return SyncConfig(
        chunk_size=int(options.get("ETL_CHUNK_SIZE", 10_000)),
        max_workers=int(options.get("ETL_MAX_WORKERS", 4)),
        retry_attempts=int(options.get("ETL_RETRY_ATTEMPTS", 5)),
        source=source,
        target=target,
    )
