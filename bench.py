"""Timings of the headline loads on local Spark; prints one JSON line.

Each figure is the median of three rounds after a warm-up round. Every round syncs into new tables. The hundred loads
run once; their figures stand beside the total, which is of the rounds.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import files
from tablesync.operators import assign_chunks, chunk_report, validate
from tablesync.plans import run_sync
from tablesync.session import builder
from tablesync.sinks import BucketedTable, suggest_buckets
from tablesync.sources import TableSource
from tablesync.spec import TableConfig, TargetSpec

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = 3
KEYS = ["l_orderkey", "l_linenumber"]
SYNC = TableConfig("lineitem", "l_shipdate", tuple(KEYS))


def session() -> SparkSession:
    return (
        builder("bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def read(target: BucketedTable) -> None:
    target.read().agg(*[F.max(c) for c in target.spec.names]).collect()


def many_loads(spark: SparkSession, lineitem: DataFrame, loads: int = 100) -> dict[str, float]:
    """A table after many loads of about one in a hundred rows each: how it reads, against the same rows compacted."""
    target = BucketedTable.create(
        spark,
        files.scratch(spark, "bench"),
        TargetSpec.from_frame("lineitem", lineitem, KEYS),
        KEYS,
        suggest_buckets(spark, f"{SF_DIR}/lineitem.parquet"),
    )
    target.upsert(lineitem, ["l_shipdate"])
    lots = [lineitem.filter(f"l_orderkey % {loads} = {k}").withColumn("l_quantity", F.lit(float(k))) for k in range(loads)]
    spent = timed(lambda: [target.upsert(lot, ["l_shipdate"]) for lot in lots])
    layers = len(target.version().layers)
    read(target)
    layered = min(timed(lambda: read(target)) for _ in range(3))
    target.compact()
    read(target)
    compacted = min(timed(lambda: read(target)) for _ in range(3))
    return {
        "hundred_loads": spent,
        "layers_after_100_loads": layers,
        "read_after_100_loads": layered,
        "read_after_100_loads_compacted": compacted,
    }


def one_round(spark: SparkSession, lineitem: DataFrame, orders: DataFrame) -> dict[str, float]:
    path = f"{SF_DIR}/lineitem.parquet"
    target = BucketedTable.create(
        spark,
        files.scratch(spark, "bench"),
        TargetSpec.from_frame("lineitem", lineitem, KEYS),
        KEYS,
        suggest_buckets(spark, path),
    )
    cut = lineitem.selectExpr("CAST(percentile_approx(CAST(l_shipdate AS TIMESTAMP), 0.99) AS TIMESTAMP_NTZ) AS c")
    cut_at = cut.first()["c"]
    old = TableSource(lineitem.filter(F.col("l_shipdate") <= F.lit(str(cut_at)).cast("timestamp_ntz")))
    whole = TableSource(lineitem)
    tenth = lineitem.filter("l_orderkey % 10 = 0").withColumn("l_quantity", F.col("l_quantity") + 1)
    few = tenth.limit(1000)
    low = dt.datetime(1999, 1, 1)
    return {
        "full_load": timed(lambda: run_sync(old, target, SYNC)),
        "incremental_1pct": timed(lambda: run_sync(whole, target, SYNC)),
        "idle_run": timed(lambda: run_sync(whole, target, SYNC)),
        "upsert_10pct": timed(lambda: target.upsert(tenth, ["l_shipdate"])),
        "upsert_1000": timed(lambda: target.upsert(few, ["l_shipdate"])),
        "replay_10pct": timed(lambda: target.upsert(tenth, ["l_shipdate"])),
        "partial_columns_10pct": timed(lambda: target.upsert(tenth.select(*KEYS, "l_quantity"))),
        "validate_all": timed(lambda: validate(lineitem, target.spec).collect()),
        "read_target": timed(lambda: read(target)),
        "compact": timed(target.compact),
        "read_compacted": timed(lambda: read(target)),
        "chunk_report": timed(
            lambda: chunk_report(TableSource(orders).by_timestamp("o_orderdate", low), 10_000).collect()
        ),
        "chunk_assign": timed(
            lambda: assign_chunks(orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"], 10_000)
            .groupBy("chunk")
            .count()
            .collect()
        ),
    }


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    rounds = [one_round(spark, lineitem, orders) for _ in range(ROUNDS + 1)][1:]
    seconds = {name: round(statistics.median(r[name] for r in rounds), 3) for name in rounds[0]}
    rows = lineitem.count()
    total = round(sum(seconds.values()), 3)
    seconds |= {name: round(value, 3) for name, value in many_loads(spark, lineitem).items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline loads",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows": rows,
                "full_load_rows_per_sec": round(rows * 0.99 / seconds["full_load"]),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
