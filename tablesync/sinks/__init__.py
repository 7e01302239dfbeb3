"""Targets and the bookkeeping tables."""

from tablesync.sinks.audit import AuditTable
from tablesync.sinks.bucketed import BucketedTable, append_rows, suggest_buckets
from tablesync.sinks.jdbc_table import JdbcTable, merge_sql
from tablesync.sinks.report import LoadSummary, Mark, PartialLoadError
from tablesync.sinks.watermark import WatermarkStore, marks_frame

__all__ = [
    "AuditTable",
    "BucketedTable",
    "JdbcTable",
    "LoadSummary",
    "Mark",
    "PartialLoadError",
    "WatermarkStore",
    "append_rows",
    "marks_frame",
    "merge_sql",
    "suggest_buckets",
]
