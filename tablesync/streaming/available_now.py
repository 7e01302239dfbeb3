"""Load all available chunks of a stream, then stop; the next start goes on where this one ended."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame

from tablesync import files
from tablesync.operators.validate import ValidationResult, null_issues, schema_issues
from tablesync.sinks.report import LoadSummary, PartialLoadError
from tablesync.spec import SyncConfig

log = logging.getLogger("tablesync")


def sync_available_now(
    stream: DataFrame,
    target: Any,
    checkpoint: str,
    order_by: Sequence[str] = (),
    config: SyncConfig = SyncConfig(),
    validate_schema: bool = True,
) -> LoadSummary:
    """Upsert every micro-batch of a streaming frame, exactly once.

    A table on files stores the stream's id and the number of the batch in the version that holds its rows. A batch that was
    committed there but not yet recorded in the checkpoint is recognised after a restart and left out; other targets merge it
    again, which gives the same rows. A failing batch stops the query and stays unrecorded.
    """
    total = LoadSummary()
    if validate_schema:
        ValidationResult.of(schema_issues(stream.sparkSession, stream.schema, target.spec)).check()

    def load(rows: DataFrame, batch: int) -> None:
        once: dict[str, Any] = {}
        if hasattr(target, "loaded_batch"):
            # Spark names a stream in its checkpoint before the first batch.
            stream_id = json.loads(files.read_text(stream.sparkSession, f"{checkpoint.rstrip('/')}/metadata"))["id"]
            done = target.loaded_batch(stream_id)
            if done is not None and batch <= done:
                log.info("%s: batch %d of the stream is in the table already", target.spec.table, batch)
                return
            once = {"stream": (stream_id, batch)}
        staged = target.stage(rows, order_by)
        if validate_schema and any(staged.nulls.values()):
            violations = ValidationResult.of(null_issues(staged.null_counts()))
            staged.discard()
            violations.check()
        summary = target.load(staged, config=config, **once)
        total.total_rows += summary.total_rows
        total.chunks_ok += summary.chunks_ok
        total.chunks_failed += summary.chunks_failed
        total.elapsed_s += summary.elapsed_s
        if summary.chunks_failed:
            raise PartialLoadError(target.spec.table, summary)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return total
