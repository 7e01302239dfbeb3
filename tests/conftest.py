from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sync_helpers import PEOPLE
from tablesync.session import builder
from tablesync.sinks import BucketedTable
from tablesync.spec import SyncConfig


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def quick():
    """Small chunks and short waits."""
    return SyncConfig(chunk_size=3, max_workers=2, retry_attempts=2, retry_wait_min=0.01, retry_wait_max=0.05)


@pytest.fixture
def people(spark, folder):
    return BucketedTable.create(spark, folder, PEOPLE, ["id"], buckets=4)
