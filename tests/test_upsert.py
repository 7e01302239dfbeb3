import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sync_helpers import PEOPLE, PEOPLE_ROWS, people_frame, rows
from tablesync import files
from tablesync.frames import local_frame
from tablesync.operators import dedup_last, merge_frames
from tablesync.sinks import BucketedTable, JdbcTable, Mark, PartialLoadError, append_rows, merge_sql, suggest_buckets
from tablesync.sinks import bucketed
from tablesync.sinks.jdbc_table import create_sql, run_transaction
from tablesync.sinks.report import with_retry
from tablesync.sources import FileLocation
from tablesync.spec import ColumnSpec, SyncConfig, TargetSpec

DAY = dt.datetime(2024, 2, 1)


def table(spark, folder, schema, keys, buckets=4):
    spec = TargetSpec.from_frame("t", local_frame(spark, [], schema))
    return BucketedTable.create(spark, folder, spec, keys, buckets)


# -- last row per key ---------------------------------------------------------------------------


def test_last_row_wins_and_nulls_come_last(spark):
    df = local_frame(
        spark,
        [(1, DAY, "old"), (1, DAY + dt.timedelta(1), "new"), (2, DAY, "set"), (2, None, "null mark"), (3, None, "only")],
        "id int, w timestamp_ntz, v string",
    )
    assert rows(dedup_last(df, ["id"], ["w"]), "id", "v") == [(1, "new"), (2, "null mark"), (3, "only")]


def test_ties_do_not_depend_on_row_order(spark):
    pairs = [(1, DAY, v) for v in "cab"]
    for order in (pairs, pairs[::-1]):
        df = local_frame(spark, order, "id int, w timestamp_ntz, v string").repartition(3)
        assert rows(dedup_last(df, ["id"], ["w"]), "v") == [("c",)]


def test_columns_that_cannot_be_ordered(spark):
    df = spark.sql("SELECT 1 AS id, 1 AS w, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert dedup_last(df, ["id"], ["w"]).first()["m"] == {"b": 2}
    assert dedup_last(df.select("id", "m"), ["id"]).count() == 1


def test_equal_keys_are_folded_before_the_shuffle(spark):
    """A hot key sends one row per task, not its rows."""
    df = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("k"), "id")
    folded = dedup_last(df, ["k"], ["id"])
    assert folded.collect() == [(1, 999)]
    plan = folded._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert "partial_max" in initial and "Window" not in plan


def test_merge_frames(spark):
    old = local_frame(spark, [(1, "a"), (2, "b")], "id int, v string")
    new = local_frame(spark, [(2, "B"), (3, "C")], "id int, v string")
    assert rows(merge_frames(old, new, ["id"])) == [(1, "a"), (2, "B"), (3, "C")]


# -- bucketed table -----------------------------------------------------------------------------


def test_insert_and_overwrite(people, spark):
    people.upsert(people_frame(spark))
    changed = [(2, "Jarle", DAY, None), (4, "Lena", DAY, 4.0)]
    summary = people.upsert(people_frame(spark, changed))
    assert rows(people.read()) == sorted([PEOPLE_ROWS[0], PEOPLE_ROWS[2], *changed])
    assert (summary.total_rows, summary.chunks_ok, summary.chunks_failed, summary.status) == (2, 1, 0, "success")
    people.compact()
    assert rows(people.read()) == sorted([PEOPLE_ROWS[0], PEOPLE_ROWS[2], *changed])
    assert people.version().bucket_rows == 4


def test_reopened_table_is_the_same(people, spark, folder):
    people.upsert(people_frame(spark))
    again = BucketedTable.open(spark, folder)
    assert (again.keys, again.buckets, again.spec) == (people.keys, people.buckets, people.spec)
    assert rows(again.read()) == rows(people.read())
    assert BucketedTable.open(spark, folder + "-none") is None


def test_create_is_idempotent_and_recreates_on_request(people, spark, folder):
    people.upsert(people_frame(spark))
    assert BucketedTable.create(spark, folder, PEOPLE, ["id"], 16).buckets == 4
    assert not BucketedTable.create(spark, folder, PEOPLE, ["id"]).is_empty()
    fresh = BucketedTable.create(spark, folder, PEOPLE, ["id"], 2, recreate=True)
    assert fresh.is_empty() and fresh.buckets == 2 and fresh.read().count() == 0


def test_drop_touches_tables_only(spark, tmp_path):
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine" / "file").write_text("x")
    BucketedTable.drop(spark, str(tmp_path / "mine"))
    assert (tmp_path / "mine" / "file").exists()


@pytest.fixture
def join_limit(spark, request):
    if request.param is not None:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("every, join_limit", [(1, "-1"), (2, None), (9, None), (9, "-1")], indirect=["join_limit"])
def test_random_batches_match_a_dictionary(spark, folder, every, join_limit):
    """Replays, partial columns and repeated keys against the obvious model, compacted after each load,
    some, and none."""
    rng = random.Random(5)
    spec = TargetSpec(
        "t",
        (ColumnSpec("a", "integer"), ColumnSpec("b", "text"), ColumnSpec("x", "bigint"), ColumnSpec("y", "bigint", default="-1")),
    )
    target = BucketedTable.create(spark, folder, spec, ["a", "b"], 4)
    model: dict[tuple[int, str], list[int | None]] = {}
    for step in range(4):
        with_y = step % 2 == 0
        drawn = [(rng.randrange(12), rng.choice("pq"), rng.randrange(100), rng.randrange(100), i) for i in range(25)]
        df = local_frame(spark, drawn, "a int, b string, x bigint, y bigint, w int")
        for _ in range(1 + (step == 1)):
            target.upsert(df if with_y else df.drop("y"), ["w"])
        for a, b, x, y, _ in drawn:
            kept = model.get((a, b), [None, -1])[1]
            model[a, b] = [x, y if with_y else kept]
        assert rows(target.read()) == sorted((a, b, x, y) for (a, b), (x, y) in model.items())
        if step % every == every - 1:
            target.compact()
            assert rows(target.read()) == sorted((a, b, x, y) for (a, b), (x, y) in model.items())
            assert target.version().layers == () and target.version().bucket_rows == len(model)


def test_absent_column_keeps_its_value_and_defaults_on_insert(spark, folder):
    spec = TargetSpec("t", (ColumnSpec("id", "integer"), ColumnSpec("v", "text"), ColumnSpec("n", "integer", default="7")))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    target.upsert(local_frame(spark, [(1, "a", None), (2, "b", 5)], "id int, v string, n int"))
    target.upsert(local_frame(spark, [(1, "A"), (2, "B"), (3, "C")], "id int, v string"))
    assert sorted((r["id"], r["v"], r["n"]) for r in target.read().collect()) == [(1, "A", None), (2, "B", 5), (3, "C", 7)]


def test_older_row_overwrites(people, spark):
    people.upsert(people_frame(spark))
    people.upsert(people_frame(spark, [(1, "Al", dt.datetime(2014, 1, 1), 1.0)]), ["updated_at"])
    assert (1, "Al", dt.datetime(2014, 1, 1), 1.0) in rows(people.read())


def test_extra_columns_are_left_out(people, spark):
    people.upsert(people_frame(spark).withColumn("more", F.lit(1)))
    assert people.read().columns == PEOPLE.names


def test_key_only_table(spark, folder):
    target = table(spark, folder, "id int", ["id"])
    target.upsert(local_frame(spark, [(1,), (2,)], "id int"))
    target.upsert(local_frame(spark, [(2,), (3,), (3,)], "id int"))
    assert rows(target.read()) == [(1,), (2,), (3,)]


def test_null_key_is_refused(people, spark):
    people.upsert(people_frame(spark))
    with pytest.raises(ValueError, match="hold NULLs"):
        people.upsert(people_frame(spark, [(None, "x", DAY, 1.0)]))
    with pytest.raises(ValueError, match="absent"):
        people.upsert(people_frame(spark).drop("id"))
    assert people.read().count() == 3


def test_value_that_does_not_fit_fails_the_load(people, spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        people.upsert(people_frame(spark, [(2**40, "x", DAY, 1.0)]))
    assert people.is_empty()


def written_rows(target, before):
    """Rows in the folders that came since a version."""
    new = [n for n in files.names(target.spark, target.path) if n[0] not in "_." and n not in before]
    return sum(target.spark.read.parquet(f"{target.path}/{n}").count() for n in new)


@pytest.mark.parametrize("changed", [5, 400, 1000, 3000])
def test_a_load_writes_no_more_rows_than_it_brings(spark, folder, changed):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=8)
    target.upsert(spark.range(1000).withColumn("v", F.lit("a")))
    live, before = target.version().live, set(files.names(spark, folder))
    target.upsert(spark.range(changed).withColumn("v", F.lit("b")))
    assert written_rows(target, before) == changed
    assert target.version().live == live and target.version().layer_rows == changed
    before = set(files.names(spark, folder))
    target.upsert(spark.range(changed).select("id"))
    assert written_rows(target, before) <= 2 * changed
    counts = {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()}
    assert counts == {k: n for k, n in (("a", max(1000 - changed, 0)), ("b", changed)) if n}


def test_later_layers_hide_earlier_ones(spark, folder):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=4)
    target.upsert(spark.range(100).withColumn("v", F.lit("a")))
    for ids, letter in ((range(5), "b"), (range(3, 8), "c"), (range(90, 110), "d"), (range(4, 5), "e")):
        target.upsert(spark.range(ids.start, ids.stop).withColumn("v", F.lit(letter)))
    want = {"a": 82, "b": 3, "c": 4, "d": 20, "e": 1}
    assert {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()} == want
    assert [layer.rows for layer in target.version().layers] == [28]
    target.compact()
    assert {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()} == want
    assert target.version().bucket_rows == 110


def test_compaction_does_not_shuffle_the_buckets(spark, folder, monkeypatch):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=4)
    target.upsert(spark.range(1000).withColumn("v", F.lit("a")))
    target.upsert(spark.range(500, 1500).withColumn("v", F.lit("b")))
    plans = []
    kept = bucketed.write_bucketed
    monkeypatch.setattr(bucketed, "write_bucketed", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, *a))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target.compact()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rewriting = plans[-1].split("Initial Plan")[-1]
    assert "LeftAnti" in rewriting and rewriting.count("Exchange") <= 1
    assert target.version().bucket_rows == 1500 == target.read().count()


def test_only_folders_with_changed_keys_are_rewritten(spark, folder):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=2)
    target.upsert(spark.range(100).withColumn("v", F.lit("a")))
    first = target.version().live
    for ids, letter in ((range(100, 150), "a"), (range(140, 160), "b")):
        target.upsert(spark.range(ids.start, ids.stop).withColumn("v", F.lit(letter)))
        target.compact()
    live = target.version().live
    assert all(first[b][0] in live[b] for b in live)
    assert target.version().bucket_rows == 160
    assert {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()} == {"a": 140, "b": 20}


def test_appended_nulls_are_refused(spark, folder):
    spec = TargetSpec("t", (ColumnSpec("id", "bigint"), ColumnSpec("v", "text", nullable=False), ColumnSpec("w", "text")))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    before = files.names(spark, folder)
    for row in ((None, "a", "x"), (1, None, "x")):
        with pytest.raises(ValueError, match="hold NULLs"):
            target.append(local_frame(spark, [row], "id bigint, v string, w string"))
    assert files.names(spark, folder) == before
    target.append(local_frame(spark, [(1, "a", None), (1, "b", None)], "id bigint, v string, w string"))
    assert target.read().count() == 2


def test_nested_values_become_json(spark, folder):
    spec = TargetSpec("t", (ColumnSpec("id", "bigint"), ColumnSpec("v", "jsonb"), ColumnSpec("a", "text")))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    df = spark.sql("SELECT 1L AS id, struct(1 AS n, 'q' AS s) AS v, array(1, 2) AS a")
    target.upsert(df)
    assert rows(target.read()) == [(1, '{"n":1,"s":"q"}', "[1,2]")]
    target.append(df)
    assert target.read().distinct().count() == 1


def test_version_files_of_the_last_release(spark, folder):
    from tablesync.sinks.layers import Layer
    from tablesync.sinks.versions import Version

    old = Version.from_json('{"number": 3, "live": {}, "recent": ["run/__batch=0", 5], "marks": {}}')
    assert old.layers == (Layer("run/__batch=0", 5),) and old.streams == {} and Version.from_json(old.to_json()) == old


def test_compact_and_append_with_layers(spark, folder):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=2)
    target.upsert(spark.range(100).withColumn("v", F.lit("a")))
    target.upsert(spark.range(5).withColumn("v", F.lit("b")))
    before = rows(target.read())
    target.compact()
    assert target.version().layers == () and target.version().bucket_rows == 100
    assert rows(target.read()) == before
    target.upsert(spark.range(5).withColumn("v", F.lit("c")))
    target.append(spark.range(3).withColumn("v", F.lit("d")))
    assert {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()} == {"a": 95, "c": 5, "d": 3}


def test_shuffle_partitions_that_do_not_line_up(spark, folder):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        target = table(spark, folder, "id bigint, v string", ["id"], buckets=3)
        target.upsert(spark.range(300).withColumn("v", F.lit("a")))
        target.upsert(spark.range(100, 200).withColumn("v", F.lit("b")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r["v"]: r["count"] for r in target.read().groupBy("v").count().collect()} == {"a": 200, "b": 100}


def test_small_layers_are_broadcast(spark, folder, monkeypatch):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=4)
    target.upsert(spark.range(1000).withColumn("v", F.lit("a")))
    plans = []
    write = bucketed.write_bucketed
    monkeypatch.setattr(
        bucketed,
        "write_bucketed",
        lambda df, *args: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *args)),
    )
    target.upsert(spark.range(0, 1000, 2).withColumn("v", F.lit("b")))
    target.compact()
    assert "BroadcastHashJoin" in plans[-1] and "hashpartitioning" not in plans[-1]


def test_files_of_a_bucket_hold_that_bucket(spark, folder):
    target = table(spark, folder, "id bigint, v string", ["id"], buckets=4)
    target.upsert(spark.range(1000).withColumn("v", F.lit("a")))
    seen = (
        target.read()
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c", 1).cast("int").alias("named"),
            F.pmod(F.hash("id"), F.lit(4)).alias("hashed"),
        )
        .distinct()
        .collect()
    )
    assert len(seen) == 4 and all(r["named"] == r["hashed"] for r in seen)


def test_crash_before_the_commit_leaves_the_old_version(people, spark, monkeypatch):
    people.upsert(people_frame(spark))
    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(ValueError("lost")))
        with pytest.raises(PartialLoadError, match="lost"):
            people.upsert(people_frame(spark, [(1, "X", DAY, 0.0)]))
    assert rows(people.read()) == PEOPLE_ROWS
    people.upsert(people_frame(spark, [(1, "X", DAY, 0.0)]))
    assert rows(people.read(), "name") == [("Jarl",), ("Kofi",), ("X",)]


def test_second_writer_is_refused(people, spark):
    version = people.version()
    people.upsert(people_frame(spark))
    with pytest.raises(FileExistsError):
        people._commit(version)
    assert people.read().count() == 3


def test_frame_read_before_a_load_stays_as_it_was(people, spark):
    people.upsert(people_frame(spark))
    before = people.read()
    people.upsert(people_frame(spark, [(1, "X", DAY, 0.0)]))
    assert rows(before) == PEOPLE_ROWS


def test_vacuum_removes_what_no_kept_version_needs(people, spark, folder):
    for i in range(4):
        people.upsert(people_frame(spark, [(1, f"v{i}", DAY, 0.0)]))
    people.compact()
    stale = people.vacuum(keep=1)
    assert stale and not set(stale) & people.version().runs
    assert set(n for n in files.names(spark, folder) if n[0] not in "_.") == people.version().runs
    assert rows(people.read(), "name") == [("v3",)]
    people.upsert(people_frame(spark))
    assert people.read().count() == 3


def test_rows_are_written_in_parallel(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        target = table(spark, folder, "id bigint, v string", ["id"], buckets=4)
        target.upsert(spark.range(1000).withColumn("v", F.lit("a")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tasks = target.read().select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)).distinct()
    assert tasks.count() == 4


def test_schema_names_the_folder(spark, tmp_path):
    BucketedTable.create(spark, str(tmp_path / "mart" / "people"), PEOPLE, ["id"])
    location = FileLocation(str(tmp_path))
    assert location.target(spark, "mart", "people", ("id",)).spec == BucketedTable.open(
        spark, str(tmp_path / "mart" / "people")
    ).spec
    assert location.target(spark, "public", "people", ("id",)) is None


def test_path_with_a_quote(spark, tmp_path):
    target = table(spark, str(tmp_path / "o'brien"), "id bigint, v string", ["id"], buckets=2)
    target.upsert(spark.range(4).withColumn("v", F.lit("a")))
    target.upsert(spark.range(2, 6).withColumn("v", F.lit("b")))
    assert target.read().count() == 6


def test_no_tables_are_left_in_the_session(people, spark):
    people.upsert(people_frame(spark))
    people.upsert(people_frame(spark, [(1, "X", DAY, 0.0)]))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tablesync")] == []


def test_append_and_append_if_empty(people, spark, tmp_path):
    people.append(people_frame(spark))
    people.append(people_frame(spark, [(1, "again", DAY, 0.0)]).drop("amount"))
    assert people.read().count() == 4
    path = str(tmp_path / "plain")
    assert append_rows(spark.range(3), path, only_if_empty=True)
    assert not append_rows(spark.range(3), path, only_if_empty=True)
    assert append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


def test_append_splits_a_hot_bucket(spark, folder):
    """All rows on one key: the bucket is written by several tasks, into files of the same bucket."""
    target = table(spark, folder, "k bigint, v string", ["k"], buckets=4)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1048576")
    try:
        hot = spark.range(0, 400_000, 1, 8).select(F.lit(7).cast("bigint").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        target.append(hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert target.read().count() == 400_000 == target.version().bucket_rows
    assert target.read().select("_metadata.file_name").distinct().count() > 1


def test_bucket_count_grows_with_the_data(spark, folder):
    spark.range(1000).write.parquet(folder)
    assert suggest_buckets(spark, folder) == 8
    assert suggest_buckets(spark, folder, bucket_bytes=100) >= 64


# -- batches and retries ------------------------------------------------------------------------


class Flaky(BucketedTable):
    failures: dict[int, int] = {}

    def _prepare(self, staged, batch):
        if self.failures.get(batch, 0) > 0:
            self.failures[batch] -= 1
            raise OSError("connection reset")


@pytest.fixture
def flaky(spark, folder):
    target = Flaky.create(spark, folder, PEOPLE, ["id"], 4)
    target.failures = {}
    return target


def test_failure_is_repeated_and_then_succeeds(flaky, spark, quick):
    flaky.failures = {0: 1}
    summary = flaky.upsert(people_frame(spark), config=quick)
    assert (summary.chunks_ok, summary.chunks_failed) == (1, 0)
    assert rows(flaky.read()) == PEOPLE_ROWS


def test_failed_batch_does_not_stop_the_others(flaky, spark, quick):
    flaky.failures = {1: 9}
    staged = flaky.stage(people_frame(spark), ["updated_at"], 3, F.col("id") % 3)
    summary = flaky.load(staged, "people", Mark(DAY), quick)
    assert (summary.total_rows, summary.chunks_ok, summary.chunks_failed) == (2, 2, 1)
    assert summary.status == "partial_failure"
    assert rows(flaky.read(), "id") == [(2,), (3,)]
    assert flaky.mark("people") == Mark()


def test_batches_by_bucket_load_everything(people, spark):
    summary = people.upsert(spark.range(200).selectExpr("id", "'n' AS name", "TIMESTAMP_NTZ '2024-01-01' AS updated_at"), batches=3)
    assert summary.total_rows == 200 and summary.chunks_ok == 3
    assert people.read().count() == 200


@pytest.mark.parametrize("number", ["3", "-1", "NULL"])
def test_batch_numbers_are_bounded(people, spark, number):
    with pytest.raises(Exception, match=f"batch_by gives {number}, not 0 to 2"):
        people.stage(people_frame(spark), batches=3, batch_by=F.expr(f"CAST({number} AS INT)"))
    assert people.is_empty()


def test_waits_grow_and_are_bounded():
    config = SyncConfig()
    assert [config.retry_wait(i) for i in (1, 2, 3, 4, 5, 6)] == [2.0, 3.0, 6.0, 12.0, 24.0, 30.0]


def test_permanent_errors_are_not_repeated(quick):
    calls = []

    def action(error):
        calls.append(1)
        raise error

    with pytest.raises(ValueError):
        with_retry(lambda: action(ValueError("no")), quick, "t")
    assert len(calls) == 1
    with pytest.raises(OSError):
        with_retry(lambda: action(OSError("no")), quick, "t")
    assert len(calls) == 3


def test_summary_counts_source_rows_and_empty_delta_is_no_batch(people, spark):
    twice = people_frame(spark).union(people_frame(spark))
    assert people.upsert(twice).total_rows == 6
    summary = people.upsert(people_frame(spark).filter("id > 9"))
    assert (summary.total_rows, summary.chunks_ok, summary.chunks_failed) == (0, 0, 0)


# -- database target: what is sent, since no database runs here ---------------------------------


def test_merge_statement():
    spec = TargetSpec("t", (ColumnSpec("id", "integer"), ColumnSpec("u", "uuid"), ColumnSpec("x", "text")), "mart")
    assert merge_sql(spec, "mart.t__staging", ["id", "u"], ["id"]) == (
        'INSERT INTO mart.t ("id", "u") SELECT CAST("id" AS integer), CAST("u" AS uuid) FROM mart.t__staging '
        'ON CONFLICT ("id") DO UPDATE SET "u" = EXCLUDED."u"'
    )
    assert merge_sql(spec, "s", ["id"], ["id"]).endswith('ON CONFLICT ("id") DO NOTHING')


def test_create_statements(spark):
    spec = TargetSpec(
        "t", (ColumnSpec("id", "integer"), ColumnSpec("n", "smallint", default="1"), ColumnSpec("p", "numeric(12,2)", False)), "mart"
    )
    create = (
        'CREATE TABLE IF NOT EXISTS mart.t ("id" integer NOT NULL, "n" smallint DEFAULT 1, '
        '"p" numeric(12,2) NOT NULL, PRIMARY KEY ("id"))'
    )
    assert create_sql(spec, ["id"]) == [create]
    assert create_sql(spec, ["id"], recreate=True) == ["DROP TABLE IF EXISTS mart.t CASCADE", create]
    connection = FakeConnection()
    JdbcTable(spark, {}, spec, ["id"], connect=lambda: connection).create(recreate=True)
    assert connection.log.count("execute") == 2 and "commit" in connection.log


class FakeConnection:
    def __init__(self, fails=False):
        self.log, self.fails = [], fails

    def setAutoCommit(self, on):
        self.log.append(("auto", on))

    def createStatement(self):
        return self

    def execute(self, sql):
        if self.fails:
            raise OSError("deadlock")
        self.log.append("execute")

    def close(self):
        self.log.append("close")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")


def test_statements_are_one_transaction():
    good = FakeConnection()
    run_transaction(good, ["a", "b"])
    assert good.log == [("auto", False), "execute", "close", "execute", "close", "commit", "close"]
    bad = FakeConnection(fails=True)
    with pytest.raises(OSError):
        run_transaction(bad, ["a"])
    assert bad.log == [("auto", False), "rollback", "close"]


def test_database_load_stages_writes_and_merges(spark, tmp_path, monkeypatch, quick):
    from tablesync.sinks import WatermarkStore

    store = WatermarkStore(spark, str(tmp_path / "marks"))
    connections, written = [], []

    def connect():
        connections.append(FakeConnection(fails=not connections))
        return connections[-1]

    target = JdbcTable(spark, {"url": "u"}, PEOPLE, ["id"], store, connect=connect)
    monkeypatch.setattr(JdbcTable, "_write_staging", lambda self, df, name: written.append(rows(df)))
    staged = target.stage(people_frame(spark).drop("name"), ["updated_at"])
    summary = target.load(staged, "people", Mark(DAY, 5), quick)
    assert summary.status == "success" and len(connections) == 2 and len(written) == 2
    assert written[0] == [(r[0], r[2], r[3]) for r in PEOPLE_ROWS]
    assert store.mark("people", "public.people") == Mark(DAY, 5) == target.mark("people")
    assert store.mark("people", "other") == Mark()


def test_marks_in_the_database_move_with_the_last_batch(spark, monkeypatch, quick):
    transactions = []
    monkeypatch.setattr("tablesync.sinks.jdbc_table.run_transaction", lambda connection, statements: transactions.append(statements))
    monkeypatch.setattr(JdbcTable, "_write_staging", lambda self, df, name: df.count())
    target = JdbcTable(spark, {"url": "u"}, PEOPLE, ["id"], connect=lambda: None)
    staged = target.stage(people_frame(spark).drop("name"), ["updated_at"], batches=2)
    target.load(staged, "o'people", Mark(DAY, 5), quick)
    kinds = [[s.split(" ")[0] for s in t] for t in transactions]
    assert kinds[-1] == ["INSERT", "DROP", "CREATE", "INSERT"] and all(k == ["INSERT", "DROP"] for k in kinds[:-1])
    last = transactions[-1][-1]
    assert "public.etl_watermarks" in last and "'o''people'" in last and "'2024-02-01 00:00:00+00', 5, now()" in last
    monkeypatch.setattr("tablesync.sinks.jdbc_table.read_jdbc", lambda *a, **k: local_frame(spark, [(DAY, 5)], "last_value timestamp_ntz, last_rowver bigint"))
    assert target.mark("people") == Mark(DAY, 5)
    transactions.clear()
    target.record("people", Mark(None, 7))
    assert "NULL, 7, now()" in transactions[0][-1] and transactions[0][0].startswith("CREATE TABLE IF NOT EXISTS")


def test_database_defaults_are_left_to_the_database(spark):
    spec = TargetSpec("t", (ColumnSpec("id", "bigint"), ColumnSpec("s", "text", default="'x'::text"), ColumnSpec("n", "bigint", default="nextval('q'::regclass)")))
    staged = JdbcTable(spark, {}, spec, ["id"]).stage(local_frame(spark, [(1,)], "id bigint"))
    assert staged.absent == ("s", "n") and staged.total_rows == 1
