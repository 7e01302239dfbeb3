import datetime as dt

import pytest
from pyspark.sql import functions as F

from sync_helpers import people_frame, rows
from tablesync.frames import local_frame
from tablesync.operators import assign_chunks, chunk_report, chunks, first_chunk, sample_rows


def sequence(spark, n):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return spark.range(n).select("id", (start + F.make_dt_interval(F.col("id") % 3)).alias("w"))


def test_last_chunk_is_shorter(spark):
    report = [tuple(r) for r in chunk_report(sequence(spark, 7), 3).orderBy("chunk").collect()]
    assert report == [(0, 3, 3, False), (1, 3, 6, False), (2, 1, 7, True)]


def test_exact_multiple(spark):
    assert [r["n"] for r in chunk_report(sequence(spark, 6), 3).orderBy("chunk").collect()] == [3, 3]


def test_empty_delta_has_no_chunks(spark):
    assert chunk_report(sequence(spark, 0), 3).count() == 0
    assert assign_chunks(sequence(spark, 0), "w", ["id"], 3).count() == 0


@pytest.fixture
def spread(spark):
    """Keep all sort partitions, as a large table would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def numbered(df, size):
    ordered = sorted(df.collect(), key=lambda r: (r["w"] is None, r["w"] or dt.datetime.min, r["id"]))
    return sorted((r["id"], i // size) for i, r in enumerate(ordered))


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_numbers_are_exact_over_partitions(spark, spread, size):
    df = sequence(spark, 2000)
    assigned = assign_chunks(df, "w", ["id"], size)
    assert rows(assigned, "id", "chunk") == numbered(df, size)
    assert sum(r["count"] for r in assigned.groupBy("chunk").count().collect()) == 2000


def test_one_watermark_holding_most_rows_and_nulls_last(spark, spread):
    hot = F.when(F.col("id") % 10 == 9, F.lit(None)).otherwise(F.lit("2024-01-01")).cast("timestamp_ntz")
    df = spark.range(0, 3000, 1, 6).select("id", hot.alias("w"))
    assigned = assign_chunks(df, "w", ["id"], 100)
    assert rows(assigned, "id", "chunk") == numbered(df, 100)


def test_first_chunk_in_watermark_order(spark):
    assert [r["id"] for r in first_chunk(people_frame(spark), "updated_at", ["id"], 2).collect()] == [1, 2]


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_first_chunk_is_exact_when_rows_are_dropped_early(spark, monkeypatch, accuracy):
    monkeypatch.setattr(chunks, "ACCURACY", accuracy)
    hot = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).when(F.col("id") % 7 > 0, F.lit("2024-02-01"))
    df = spark.range(0, 20000, 1, 8).select((F.col("id") * 7919 % 20000).alias("id"), hot.cast("timestamp_ntz").alias("w"))
    want = sorted((r for r in df.collect() if r["w"]), key=lambda r: (r["w"], r["id"]))[:50]
    assert first_chunk(df, "w", ["id"], 50).collect() == want
    numbers = spark.range(0, 5000, 1, 4).select((F.col("id") * 37 % 5000).alias("w"))
    assert [r["w"] for r in first_chunk(numbers, "w", [], 100).collect()] == list(range(100))
    assert first_chunk(numbers, "w", [], 6000).count() == 5000


def test_sample_is_reproducible_with_keys(spark):
    df = spark.range(5000)
    assert rows(sample_rows(df, 20, ["id"])) == rows(sample_rows(df.repartition(7), 20, ["id"]))


def test_random_sample_has_the_wanted_size(spark):
    assert sample_rows(spark.range(5), 10).count() == 5
    assert sample_rows(spark.range(5000), 10, seed=1).distinct().count() == 10
    assert rows(sample_rows(spark.range(5000), 10, seed=1)) == rows(sample_rows(spark.range(5000), 10, seed=1))


def test_first_chunk_needs_no_sort_of_the_whole(spark, folder):
    people_frame(spark).write.parquet(folder)
    plan = first_chunk(spark.read.parquet(folder), "updated_at", ["id"], 2)._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_local_frame_without_rows(spark):
    assert local_frame(spark, [], "a bigint, b timestamp_ntz").collect() == []
