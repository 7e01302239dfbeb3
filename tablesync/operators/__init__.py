"""Frame-to-frame operators."""

from tablesync.operators.chunks import assign_chunks, chunk_report, first_chunk, sample_rows
from tablesync.operators.extract import high_watermark, incremental
from tablesync.operators.fold import dedup_last
from tablesync.operators.merge import merge_frames
from tablesync.operators.reconcile import count_since, differences, differing_buckets, reconcile
from tablesync.operators.validate import (
    SchemaValidationError,
    ValidationResult,
    null_counts,
    schema_issues,
    summarize,
    type_matrix,
    validate,
)

__all__ = [
    "SchemaValidationError",
    "ValidationResult",
    "assign_chunks",
    "chunk_report",
    "count_since",
    "dedup_last",
    "differences",
    "differing_buckets",
    "first_chunk",
    "high_watermark",
    "incremental",
    "merge_frames",
    "null_counts",
    "reconcile",
    "sample_rows",
    "schema_issues",
    "summarize",
    "type_matrix",
    "validate",
]
