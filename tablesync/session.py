"""A session with the settings the loads are laid out for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Watermarks are wall-clock times without a zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Tasks that hold a few buckets write them side by side instead of sorting by bucket first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # Checkpointed rows are removed when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Tables that are synced side by side share the cluster.
    "spark.scheduler.mode": "FAIR",
}


def builder(app: str = "tablesync") -> SparkSession.Builder:
    """Add the cluster's own settings: shuffle partitions, memory, ``spark.checkpoint.dir``."""
    configured = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        configured = configured.config(key, value)
    return configured
