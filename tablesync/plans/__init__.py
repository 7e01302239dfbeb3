"""Runs: one table, many tables, and the job entry."""

from tablesync.plans.pipeline import run_many, run_pipeline, run_sync

__all__ = ["run_many", "run_pipeline", "run_sync"]
