"""What a load returns, what it remembers, and how a batch is retried."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any, TypeVar

from pyspark import SparkContext, inheritable_thread_target
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import SparkSession

from tablesync.spec import SyncConfig

log = logging.getLogger("tablesync")
R = TypeVar("R")

# Repeating these gives the same error again.
PERMANENT = (AnalysisException, ParseException, ValueError, TypeError, NotImplementedError)


@dataclass(frozen=True)
class Mark:
    """The two independent watermark slots of one source table."""

    last_value: dt.datetime | None = None
    last_rowver: int | None = None

    def slot(self, mode: str) -> dt.datetime | int | None:
        return self.last_value if mode == "timestamp" else self.last_rowver


@dataclass
class LoadSummary:
    total_rows: int = 0
    chunks_ok: int = 0
    chunks_failed: int = 0
    elapsed_s: float = 0.0
    error: str | None = None

    @property
    def status(self) -> str:
        return "success" if self.chunks_failed == 0 else "partial_failure"


class PartialLoadError(RuntimeError):
    """Some batches of a load failed; carries the summary. The watermark was not moved."""

    def __init__(self, table: str, summary: LoadSummary) -> None:
        self.summary = summary
        super().__init__(f"{summary.chunks_failed} failed batch(es) for table {table}: {summary.error}")


def with_retry(action: Callable[[], R], config: SyncConfig, what: str) -> R:
    """Run a batch action, waiting longer after each failure. Permanent errors are not repeated."""
    attempt = 1
    while True:
        try:
            return action()
        except PERMANENT:
            raise
        except Exception as error:
            if attempt >= config.retry_attempts:
                raise
            wait = config.retry_wait(attempt)
            log.warning("%s: attempt %d failed, next in %.2f s: %s", what, attempt, wait, error)
            time.sleep(wait)
            attempt += 1


def run_batches(
    batches: list[tuple[int, int]],
    load: Callable[[int, bool], Any],
    config: SyncConfig,
    what: str,
    last_alone: bool = True,
    finish: Callable[[list[int], bool], Any] | None = None,
) -> LoadSummary:
    """Load ``(batch, rows)`` side by side, up to ``config.max_workers`` at a time; a failed batch stops no other.

    Each has a scheduler pool of its own, so none waits for all tasks of another. With ``last_alone`` the last batch waits for
    the others, and ``load(batch, final)`` gets ``final`` true for it when none failed. ``finish(loaded, complete)``
    then makes the loaded batches visible, in their order; if it fails, so has every batch.
    """
    start = time.monotonic()
    summary = LoadSummary()
    loaded: dict[int, int] = {}

    def attempt(name: str, action: Callable[[], Any]) -> bool:
        try:
            with_retry(action, config, name)
            return True
        except Exception as error:
            log.error("%s failed: %s", name, error)
            summary.error = summary.error or f"{type(error).__name__}: {error}"
            return False

    def one(batch: int, rows: int, final: bool) -> None:
        name = f"{what} batch {batch}"
        with _pool(name):
            if attempt(name, lambda: load(batch, final)):
                loaded[batch] = rows

    first, last = (batches[:-1], batches[-1:]) if last_alone else (batches, [])
    if len(first) > 1:
        with ThreadPoolExecutor(max_workers=max(config.max_workers, 1)) as pool:
            session = SparkSession.getActiveSession()
            task = inheritable_thread_target(session)(one) if session is not None else one
            waiting = [pool.submit(task, batch, rows, False) for batch, rows in first]
            for future in waiting:
                future.result()
    else:
        for batch, rows in first:
            one(batch, rows, False)
    for batch, rows in last:
        one(batch, rows, len(loaded) == len(first))
    if finish is not None and loaded:
        order = [batch for batch, _ in batches if batch in loaded]
        if not attempt(f"{what} commit", lambda: finish(order, len(loaded) == len(batches))):
            loaded.clear()
    summary.chunks_ok, summary.total_rows = len(loaded), sum(loaded.values())
    summary.chunks_failed = len(batches) - len(loaded)
    summary.elapsed_s = round(time.monotonic() - start, 2)
    log.info("%s: %s %s", what, summary.status, summary)
    return summary


@contextmanager
def _pool(name: str) -> Iterator[None]:
    """Spark jobs of this thread run in a scheduler pool of the given name."""
    context = SparkContext._active_spark_context
    if context is None:
        yield
        return
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)
