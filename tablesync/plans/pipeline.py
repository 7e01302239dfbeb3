"""A sync run: low mark, high mark, delta, checks, upsert, new mark, audit row."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.columns import ROWVER
from tablesync.operators.chunks import first_chunk
from tablesync.operators.validate import ValidationResult, null_counts, null_issues, schema_issues
from tablesync.sinks.audit import AuditTable, RunResult, results_frame
from tablesync.sinks.report import LoadSummary, Mark, PartialLoadError
from tablesync.sinks.versions import utc_now
from tablesync.sources.frames import TableSource
from tablesync.spec import SyncConfig, TableConfig

log = logging.getLogger("tablesync")


def _nothing_new(high: Any, low: Any) -> bool:
    return low is not None and (high is None or high <= low)


def _sync(
    source: TableSource, target: Any, table: TableConfig, config: SyncConfig, validate_schema: bool
) -> tuple[RunResult, LoadSummary]:
    spark = source.spark
    stored = target.mark(table.table) if target is not None else Mark()
    low = stored.slot(table.mode)
    if table.mode == "timestamp":
        # Taken before the read: rows that arrive meanwhile lie above it and wait for the next run.
        high = source.high(table.watermark_col, low)
        delta = source.by_timestamp(table.watermark_col, low, high)
        order = table.watermark_col
    else:
        high = source.high_rowversion(table.watermark_col, low)
        delta = source.by_rowversion(table.watermark_col, low, high)
        order = ROWVER

    idle = _nothing_new(high, low) if low is not None else high is None and delta.isEmpty()
    if target is None or (validate_schema and not idle):
        spec = target.spec if target is not None else None
        ValidationResult.of(schema_issues(spark, delta.schema, spec, table.target)).check()
    result = RunResult(table.table, table.target, table.mode)
    if idle:
        moved = table.mode == "timestamp" and high is not None
        mark = replace(stored, last_value=high) if moved else stored
        target.record(table.table, mark)
        summary = LoadSummary()
    else:
        if validate_schema and config.validation_scope == "first_chunk":
            required = [c for c in target.spec.required if c in delta.columns]
            head = first_chunk(delta, order, table.conflict_columns, config.chunk_size)
            ValidationResult.of(null_issues(null_counts(head, required))).check()
        staged = target.stage(delta, [order], config.batches)
        if validate_schema and config.validation_scope == "all" and any(staged.nulls.values()):
            violations = ValidationResult.of(null_issues(staged.null_counts()))
            staged.discard()
            violations.check()
        if table.mode == "timestamp":
            mark = replace(stored, last_value=high) if high is not None else stored
        else:
            mark = replace(stored, last_rowver=high) if (high or 0) > 0 else stored
        summary = target.load(staged, table.table, mark, config)
    if table.mode == "timestamp":
        result = replace(result, low=low, high=high)
    else:
        result = replace(result, low_rowver=low, high_rowver=mark.last_rowver)
    result = replace(
        result,
        total_rows=summary.total_rows,
        chunks_ok=summary.chunks_ok,
        chunks_failed=summary.chunks_failed,
        status=summary.status,
        error=summary.error,
    )
    return result, summary


def _audited(
    table: TableConfig, audit: AuditTable | None, sync: Callable[[], tuple[RunResult, LoadSummary]]
) -> RunResult:
    """Run, record the outcome whatever it is, and raise what went wrong."""
    table.check_mode()
    start = time.monotonic()
    failure: Exception | None = None
    try:
        result, summary = sync()
        if summary.chunks_failed:
            failure = PartialLoadError(table.table, summary)
    except Exception as error:
        log.error("%s: run failed: %s", table.table, error)
        failure = error
        result = RunResult(
            table.table, table.target, table.mode, status="failed", error=f"{type(error).__name__}: {error}"
        )
    result = replace(result, elapsed_s=round(time.monotonic() - start, 2), finished_at=utc_now())
    if audit is not None:
        audit.append(result)
    if failure is not None:
        raise failure
    return result


def run_sync(
    source: TableSource,
    target: Any,
    table: TableConfig,
    config: SyncConfig = SyncConfig(),
    audit: AuditTable | None = None,
    validate_schema: bool = True,
) -> RunResult:
    """Bring a target up to date with its source.

    Errors while reading or checking are raised and leave target and mark as they were. If batches
    fail, the others stay loaded, the mark stays, and :class:`PartialLoadError` is raised. Every run
    leaves an audit row.
    """
    return _audited(table, audit, lambda: _sync(source, target, table, config, validate_schema))


def run_pipeline(
    spark: SparkSession,
    table: str,
    mode: str,
    watermark_col: str,
    conflict_columns: Sequence[str],
    target_table: str | None = None,
    config: SyncConfig = SyncConfig(),
    validate_schema: bool = True,
    target_schema: str = "public",
    audit: AuditTable | None = None,
) -> RunResult:
    """Sync one table between the two locations named by ``config.source`` and ``config.target``."""
    entry = TableConfig(table, watermark_col, tuple(conflict_columns), mode, target_table)

    def sync() -> tuple[RunResult, LoadSummary]:
        source = config.source.source(spark, table)
        target = config.target.target(spark, target_schema, entry.target, entry.conflict_columns)
        return _sync(source, target, entry, config, validate_schema)

    return _audited(entry, audit, sync)


def run_many(
    spark: SparkSession,
    tables: Sequence[TableConfig],
    run: Callable[[TableConfig], RunResult],
    max_workers: int = 4,
) -> DataFrame:
    """Sync several tables side by side, each in a scheduler pool of its own; one row per table.

    The tables are independent: one that fails is reported in its row and does not stop the others.
    """
    def one(table: TableConfig) -> RunResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sync-{table.target}")
        try:
            return run(table)
        except PartialLoadError as error:
            s = error.summary
            return RunResult(
                table.table,
                table.target,
                table.mode,
                total_rows=s.total_rows,
                chunks_ok=s.chunks_ok,
                chunks_failed=s.chunks_failed,
                elapsed_s=s.elapsed_s,
                status=s.status,
                error=s.error,
                finished_at=utc_now(),
            )
        except Exception as error:
            return RunResult(
                table.table,
                table.target,
                table.mode,
                status="failed",
                error=f"{type(error).__name__}: {error}",
                finished_at=utc_now(),
            )
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if not tables:
        return results_frame(spark, [])
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        results = list(pool.map(one, tables))
    return results_frame(spark, results)
