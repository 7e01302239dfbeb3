"""Small metadata files and folders on the cluster's file system, through Hadoop's own client."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file completely, then give it its name. An existing file is never replaced."""
    fs, p = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(path)


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors share: the one the cluster names, else one in the
    warehouse, never a folder of one machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/_tablesync")
        current = spark.sparkContext.getCheckpointDir()
    return current


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def scratch(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh path below the shared folder, or below that of the :func:`scratch_run` that is under way."""
    root = _RUN.get() or checkpoint_root(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """A folder for all intermediate data of a piece of work, removed at its end: write the result elsewhere before."""
    path = scratch(spark, label)
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        delete_tree(spark, path)
