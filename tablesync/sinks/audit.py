"""One row per run."""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tablesync import files
from tablesync.frames import local_frame

log = logging.getLogger("tablesync")

AUDIT_SCHEMA = (
    "table_name string, target_table string, mode string, low timestamp_ntz, high timestamp_ntz, "
    "low_rowver bigint, high_rowver bigint, total_rows bigint, chunks_ok bigint, chunks_failed bigint, "
    "elapsed_s double, status string, error string, finished_at timestamp_ntz"
)


@dataclass(frozen=True)
class RunResult:
    table_name: str
    target_table: str
    mode: str
    low: dt.datetime | None = None
    high: dt.datetime | None = None
    low_rowver: int | None = None
    high_rowver: int | None = None
    total_rows: int = 0
    chunks_ok: int = 0
    chunks_failed: int = 0
    elapsed_s: float = 0.0
    status: str = "success"
    error: str | None = None
    finished_at: dt.datetime | None = None


def results_frame(spark: SparkSession, results: list[RunResult]) -> DataFrame:
    return local_frame(spark, [tuple(asdict(r).values()) for r in results], AUDIT_SCHEMA)


class AuditTable:
    """Appended to by every run, failed ones included: one small file per run, so runs side by side
    never meet."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def append(self, result: RunResult) -> None:
        """Record a run. That it could not be recorded is logged and does not change what the run did."""
        values = {k: v.isoformat() if isinstance(v, dt.datetime) else v for k, v in asdict(result).items()}
        try:
            files.publish_text(self.spark, f"{self.path.rstrip('/')}/{uuid.uuid4().hex}.json", json.dumps(values))
        except Exception as error:
            log.error("%s: no audit row: %s", result.table_name, error)

    def read(self) -> DataFrame:
        if not files.exists(self.spark, self.path):
            return local_frame(self.spark, [], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).json(self.path).orderBy("finished_at")
