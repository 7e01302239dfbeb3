"""Incremental table sync on Spark."""

from tablesync.plans.pipeline import run_many, run_pipeline, run_sync
from tablesync.sinks import AuditTable, BucketedTable, JdbcTable, LoadSummary, Mark, PartialLoadError, WatermarkStore
from tablesync.sources import FileLocation, JdbcLocation, JdbcSource, TableSource
from tablesync.spec import ColumnSpec, Connection, SyncConfig, TableConfig, TargetSpec, load_config

__all__ = [
    "AuditTable",
    "BucketedTable",
    "ColumnSpec",
    "Connection",
    "FileLocation",
    "JdbcLocation",
    "JdbcSource",
    "JdbcTable",
    "LoadSummary",
    "Mark",
    "PartialLoadError",
    "SyncConfig",
    "TableConfig",
    "TableSource",
    "TargetSpec",
    "WatermarkStore",
    "load_config",
    "run_many",
    "run_pipeline",
    "run_sync",
]
