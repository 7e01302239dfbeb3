import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sync_helpers import PEOPLE, PEOPLE_ROWS, people_frame, rows
from tablesync.frames import local_frame
from tablesync.operators import SchemaValidationError
from tablesync.plans import run_many, run_pipeline, run_sync
from tablesync.plans.job import main
from tablesync.sinks import AuditTable, BucketedTable, Mark, PartialLoadError, WatermarkStore, marks_frame
from tablesync.sources import FileLocation, TableSource
from tablesync.spec import ColumnSpec, SyncConfig, TableConfig, TargetSpec
from tablesync.streaming import sync_available_now

SYNC = TableConfig("people", "updated_at", ("id",))
LAST = dt.datetime(2024, 1, 3)


def source(spark, data=PEOPLE_ROWS):
    return TableSource(people_frame(spark, data))


@pytest.fixture
def audit(spark, tmp_path):
    return AuditTable(spark, str(tmp_path / "audit"))


def test_runs_load_all_then_only_what_is_new(people, spark, audit):
    first = run_sync(source(spark), people, SYNC, audit=audit)
    assert (first.low, first.high, first.total_rows, first.status) == (None, LAST, 3, "success")
    later = [*PEOPLE_ROWS, (2, "Jarle", dt.datetime(2024, 2, 1), 2.0), (4, "Lena", dt.datetime(2024, 2, 2), 4.0)]
    second = run_sync(source(spark, later), people, SYNC, audit=audit)
    assert (second.low, second.high, second.total_rows) == (LAST, dt.datetime(2024, 2, 2), 2)
    third = run_sync(source(spark, later), people, SYNC, audit=audit)
    assert (third.total_rows, third.chunks_ok) == (0, 0)
    assert rows(people.read(), "name") == [("Ines",), ("Jarle",), ("Kofi",), ("Lena",)]
    assert [r["total_rows"] for r in audit.read().collect()] == [3, 2, 0]
    assert people.mark("people") == Mark(dt.datetime(2024, 2, 2))


def test_many_runs_equal_one_full_load(spark, tmp_path):
    days = [(i, f"n{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 7 % 50), float(i)) for i in range(60)]
    whole = BucketedTable.create(spark, str(tmp_path / "whole"), PEOPLE, ["id"], 4)
    parts = BucketedTable.create(spark, str(tmp_path / "parts"), PEOPLE, ["id"], 4)
    run_sync(source(spark, days), whole, SYNC)
    for hours in (10, 11, 30, 50):
        end = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)
        run_sync(source(spark, [d for d in days if d[2] <= end]), parts, SYNC)
    assert rows(whole.read()) == rows(parts.read()) == sorted(days)


def test_row_tied_with_the_mark_is_not_read_again(people, spark):
    run_sync(source(spark), people, SYNC)
    tied = [*PEOPLE_ROWS, (9, "late", LAST, 0.0)]
    assert run_sync(source(spark, tied), people, SYNC).total_rows == 0


def test_null_watermarks_load_with_the_first_run_only(spark, folder):
    spec = TargetSpec.from_frame("t", local_frame(spark, [], "id bigint, w timestamp_ntz"))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    config = TableConfig("t", "w", ("id",))
    run_sync(TableSource(local_frame(spark, [(1, LAST), (2, None)], "id bigint, w timestamp_ntz")), target, config)
    after = local_frame(spark, [(1, LAST), (2, None), (3, None)], "id bigint, w timestamp_ntz")
    assert run_sync(TableSource(after), target, config).total_rows == 0
    assert rows(target.read(), "id") == [(1,), (2,)]


def test_source_without_any_watermark_loads_but_sets_no_mark(spark, folder):
    spec = TargetSpec.from_frame("t", local_frame(spark, [], "id bigint, w timestamp_ntz"))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    rows_only = TableSource(local_frame(spark, [(1, None)], "id bigint, w timestamp_ntz"))
    assert run_sync(rows_only, target, TableConfig("t", "w", ("id",))).total_rows == 1
    assert target.mark("t") == Mark()


def test_empty_source_leaves_the_mark(people, spark):
    assert run_sync(source(spark, []), people, SYNC).total_rows == 0
    assert people.mark("people") == Mark()
    run_sync(source(spark), people, SYNC)
    run_sync(source(spark, []), people, SYNC)
    assert people.mark("people") == Mark(LAST)
    assert people.read().count() == 3


def test_source_that_was_set_back_moves_the_mark_back(people, spark):
    run_sync(source(spark), people, SYNC)
    run_sync(source(spark, PEOPLE_ROWS[:2]), people, SYNC)
    assert people.mark("people") == Mark(dt.datetime(2024, 1, 2))


def test_an_idle_run_reads_the_rows_around_the_mark_only(people, spark, monkeypatch, tmp_path):
    for k, row in enumerate(PEOPLE_ROWS):
        people_frame(spark, [row]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    there = TableSource(spark.read.parquet(str(tmp_path / "in")))
    run_sync(there, people, SYNC)
    from tablesync.sources import frames

    scans = []
    whole = frames.high_watermark
    monkeypatch.setattr(frames, "high_watermark", lambda df, column, low=None: (scans.append(low), whole(df, column, low))[1])
    assert run_sync(there, people, SYNC).total_rows == 0
    assert scans == [LAST]  # only above the mark: the column is not read from the start
    plan = frames.at_watermark(there.frame, "updated_at", LAST)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(updated_at" in plan
    run_sync(TableSource(there.frame.filter("id < 3")), people, SYNC)
    assert scans == [LAST, LAST, None] and people.mark("people") == Mark(dt.datetime(2024, 1, 2))


def versioned(spark, data):
    df = local_frame(spark, data, "id bigint, name string, n bigint")
    return TableSource(df.withColumn("rv", F.unhex(F.lpad(F.hex("n"), 16, "0"))).drop("n"))


def test_rowversion_runs(spark, folder):
    spec = TargetSpec.from_frame("accounts", versioned(spark, []).frame)
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    config = TableConfig("accounts", "rv", ("id",), mode="rowversion")
    data = [(1, "Ines", 1001), (2, "Jarl", 1002)]
    first = run_sync(versioned(spark, data), target, config)
    assert (first.low_rowver, first.high_rowver, first.total_rows) == (None, 1002, 2)
    assert "__rowver" not in target.read().columns and "rv" in target.read().columns
    second = run_sync(versioned(spark, [*data, (1, "Al", 1003), (1, "Ali", 1004)]), target, config)
    assert (second.low_rowver, second.high_rowver, second.total_rows) == (1002, 1004, 2)
    assert rows(target.read(), "name") == [("Ali",), ("Jarl",)]
    third = run_sync(versioned(spark, data), target, config)
    assert (third.total_rows, target.mark("accounts")) == (0, Mark(None, 1004))


def test_rowversion_mark_is_stored_only_above_zero(spark, folder):
    spec = TargetSpec.from_frame("accounts", versioned(spark, []).frame)
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    config = TableConfig("accounts", "rv", ("id",), mode="rowversion")
    assert run_sync(versioned(spark, [(1, "a", -5), (2, "b", 0)]), target, config).total_rows == 2
    assert target.mark("accounts") == Mark()


def test_unknown_mode(people, spark):
    with pytest.raises(ValueError, match="Unknown mode: cdc. Use 'timestamp' or 'rowversion'."):
        run_sync(source(spark), people, TableConfig("people", "updated_at", ("id",), mode="cdc"))


def test_read_error_changes_nothing(people, spark, audit):
    run_sync(source(spark), people, SYNC)
    broken = people_frame(spark, [*PEOPLE_ROWS, (9, "x", dt.datetime(2025, 1, 1), 1.0)]).withColumn(
        "amount", F.when(F.col("id") == 9, F.raise_error(F.lit("link down")).cast("double")).otherwise(F.col("amount"))
    )
    with pytest.raises(Exception, match="link down"):
        run_sync(TableSource(broken), people, SYNC, audit=audit)
    assert rows(people.read()) == PEOPLE_ROWS and people.mark("people") == Mark(LAST)
    assert audit.read().first()["status"] == "failed"


@pytest.mark.parametrize("scope", ["all", "first_chunk"])
def test_validation_failure_changes_nothing(people, spark, scope):
    bad = [(1, "a", LAST, 1.0), (None, "b", LAST, 1.0)]
    with pytest.raises(SchemaValidationError, match="nullable_violation"):
        run_sync(source(spark, bad), people, SYNC, SyncConfig(validation_scope=scope))
    assert people.is_empty() and people.mark("people") == Mark()
    with pytest.raises(SchemaValidationError, match="type_mismatch"):
        run_sync(TableSource(people_frame(spark).withColumn("amount", F.lit("x"))), people, SYNC)
    assert people.version().number == 0


def test_validation_can_be_switched_off(people, spark):
    text = people_frame(spark).withColumn("amount", F.lit("1.5"))
    run_sync(TableSource(text), people, SYNC, validate_schema=False)
    assert {r["amount"] for r in people.read().collect()} == {1.5}


def test_missing_target(spark):
    with pytest.raises(SchemaValidationError, match="table_not_found"):
        run_sync(source(spark), None, SYNC)


class Broken(BucketedTable):
    def _prepare(self, staged, batch):
        if batch == 0:
            raise OSError("no")


def test_partial_failure_raises_and_keeps_the_mark(spark, folder, quick, audit):
    Broken.create(spark, folder, PEOPLE, ["id"], 4)
    target = Broken.open(spark, folder)
    config = SyncConfig(**{**quick.__dict__, "batches": 2})
    many = [(i, "n", LAST, 1.0) for i in range(50)]
    with pytest.raises(PartialLoadError) as caught:
        run_sync(source(spark, many), target, SYNC, config, audit)
    assert caught.value.summary.chunks_failed == 1 and caught.value.summary.chunks_ok == 1
    assert target.mark("people") == Mark() and 0 < target.read().count() < 50
    row = audit.read().first()
    assert (row["status"], row["chunks_failed"]) == ("partial_failure", 1)
    healed = BucketedTable.open(spark, folder)
    run_sync(source(spark, many), healed, SYNC, config)
    assert healed.read().count() == 50 and healed.mark("people") == Mark(LAST)


def test_two_targets_of_one_source_have_their_own_marks(spark, tmp_path):
    for name in ("a", "b"):
        target = BucketedTable.create(spark, str(tmp_path / name), PEOPLE, ["id"], 2)
        assert run_sync(source(spark), target, TableConfig("people", "updated_at", ("id",), target_table=name)).total_rows == 3


# -- several tables, job entry ------------------------------------------------------------------


@pytest.fixture
def place(spark, tmp_path):
    people_frame(spark).write.parquet(str(tmp_path / "in" / "people.parquet"))
    people_frame(spark).write.parquet(str(tmp_path / "in" / "persons"))
    for name in ("people", "persons"):
        BucketedTable.create(spark, str(tmp_path / "out" / "public" / name), PEOPLE, ["id"], 2)
    return tmp_path


def test_locations(spark, place):
    config = SyncConfig(source=FileLocation(str(place / "in")), target=FileLocation(str(place / "out")))
    result = run_pipeline(spark, "persons", "timestamp", "updated_at", ["id"], "people", config)
    assert (result.table_name, result.target_table, result.total_rows) == ("persons", "people", 3)
    assert BucketedTable.open(spark, str(place / "out" / "public" / "people")).read().count() == 3
    with pytest.raises(ValueError, match="Unknown mode"):
        run_pipeline(spark, "persons", "x", "updated_at", ["id"], config=config)


def test_tables_are_independent(spark, place):
    config = SyncConfig(source=FileLocation(str(place / "in")), target=FileLocation(str(place / "out")))
    tables = TableConfig.from_json(
        json.dumps(
            [{"table": t, "watermark_col": "updated_at", "conflict_columns": ["id"]} for t in ("people", "gone", "persons")]
        )
    )
    assert tables[0].mode == "timestamp" and tables[0].target == "people"

    def run(table):
        return run_pipeline(spark, table.table, table.mode, table.watermark_col, table.conflict_columns, None, config)

    results = {r["table_name"]: (r["status"], r["total_rows"]) for r in run_many(spark, tables, run).collect()}
    assert results == {"people": ("success", 3), "gone": ("failed", 0), "persons": ("success", 3)}


def test_no_tables(spark):
    assert run_many(spark, TableConfig.from_json("[]"), None).count() == 0


def test_job(spark, place):
    folders = ["--source", str(place / "in"), "--target", str(place / "out"), "--audit", str(place / "audit")]
    one = ["--table", "people", "--watermark-col", "updated_at", "--conflict-cols", "id", *folders]
    assert main(one) == 0
    listed = json.dumps([{"table": "people", "watermark_col": "updated_at", "conflict_columns": ["id"]},
                         {"table": "gone", "watermark_col": "updated_at", "conflict_columns": ["id"]}])
    assert main(["--tables", listed, *folders]) == 1
    assert AuditTable(spark, str(place / "audit")).read().count() == 3
    assert main(["--tables", "[]", *folders]) == 0
    with pytest.raises(SystemExit):
        main(["--table", "people", *folders])


def test_mappings_by_table_come_from_the_environment_as_json(monkeypatch):
    from tablesync.plans.job import _config, parser

    for side in ("SOURCE", "TARGET"):
        for name, value in {"DIALECT": "oracle", "HOST": "h", "DATABASE": "d", "USER": "u", "PASSWORD": "p"}.items():
            monkeypatch.setenv(f"{side}_{name}", value)
    args = parser().parse_args(["--table", "t", "--watermark-col", "w", "--conflict-cols", "id"])
    assert _config(args).source.partition_columns == {} == _config(args).source.custom_schemas
    monkeypatch.setenv("PARTITION_COLUMNS", '{"t": "id"}')
    monkeypatch.setenv("CUSTOM_SCHEMAS", '{"t": "ID BIGINT"}')
    location = _config(args).source
    assert location.partition_columns.get("t") == "id" and location.custom_schemas["t"] == "ID BIGINT"
    source = location.source(None, "t")
    assert (source.partition_column, source.num_partitions, source.custom_schema) == ("id", 4, "ID BIGINT")
    monkeypatch.setenv("PARTITION_COLUMNS", '["t"]')
    with pytest.raises(ValueError, match="PARTITION_COLUMNS maps"):
        _config(args)


# -- watermark store ----------------------------------------------------------------------------


def test_store_slots_are_independent(spark, tmp_path):
    store = WatermarkStore(spark, str(tmp_path / "marks"))
    assert store.get_last_timestamp("t") is None and store.get_last_rowversion("t") is None
    assert store.read().count() == 0
    store.update_timestamp("t", dt.datetime(2024, 6, 1, 12, tzinfo=dt.timezone.utc))
    assert store.get_last_rowversion("t") is None
    store.update_rowversion("t", 98765)
    assert store.get_last_timestamp("t") == dt.datetime(2024, 6, 1, 12)
    store.update_rowversion("t", 54321)
    assert WatermarkStore(spark, str(tmp_path / "marks")).get_last_rowversion("t") == 54321
    row = store.read().first()
    assert (row["table_name"], row["last_value"], row["last_rowver"]) == ("t", dt.datetime(2024, 6, 1, 12), 54321)
    assert row["updated_at"] is not None
    assert store.get_last_timestamp("t", "elsewhere") is None


def test_store_takes_turns(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = WatermarkStore(spark, str(tmp_path / "marks"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.update_rowversion(f"t{i}", i), range(12)))
    assert sorted(r["last_rowver"] for r in store.read().collect()) == list(range(12))


def test_marks_of_tables(people, spark):
    run_sync(source(spark), people, SYNC)
    assert rows(marks_frame(spark, [people]), "table_name", "target_table", "last_value") == [("people", "people", LAST)]


# -- stream -------------------------------------------------------------------------------------


def test_stream_loads_what_is_there_and_goes_on(people, spark, tmp_path):
    arrivals, progress = str(tmp_path / "arrivals"), str(tmp_path / "progress")

    def arrive(*data):
        people_frame(spark, list(data)).coalesce(1).write.mode("append").parquet(arrivals)

    def start():
        schema = people_frame(spark).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
        return sync_available_now(stream, people, progress, ["updated_at"])

    arrive(*PEOPLE_ROWS[:2])
    arrive(PEOPLE_ROWS[2])
    first = start()
    assert (first.total_rows, first.chunks_ok) == (3, 2)
    arrive((1, "Al", LAST, 1.0))
    assert start().total_rows == 1
    assert start().total_rows == 0
    assert rows(people.read(), "name") == [("Al",), ("Jarl",), ("Kofi",)]


def test_stream_refuses_bad_rows(people, spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    people_frame(spark, [(1, "a", None, 1.0)]).write.parquet(arrivals)
    stream = spark.readStream.schema(people_frame(spark).schema).parquet(arrivals)
    with pytest.raises(Exception, match="nullable_violation"):
        sync_available_now(stream, people, str(tmp_path / "progress"))
    assert people.is_empty()


def test_runs_side_by_side_leave_all_their_audit_rows(spark, audit):
    from concurrent.futures import ThreadPoolExecutor

    from tablesync.sinks.audit import RunResult

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: audit.append(RunResult(f"t{k}", "t", "timestamp", total_rows=k, high=dt.datetime(2024, 1, 1, 0, 0, 0, k))), range(40)))
    found = audit.read().collect()
    assert sorted(r["total_rows"] for r in found) == list(range(40))
    assert {r["high"] for r in found} == {dt.datetime(2024, 1, 1, 0, 0, 0, k) for k in range(40)}


def test_an_audit_error_does_not_change_the_run(people, spark, monkeypatch, audit):
    monkeypatch.setattr("tablesync.files.publish_text", publish_unless_audit(audit.path))
    assert run_sync(source(spark), people, SYNC, audit=audit).total_rows == 3


def publish_unless_audit(path):
    from tablesync import files

    publish = files.publish_text

    def refuse(spark, name, text):
        if name.startswith(path):
            raise OSError("no space left")
        publish(spark, name, text)

    return refuse


def test_an_empty_source_is_not_validated(spark, folder):
    spec = TargetSpec("people", (ColumnSpec("id", "integer", nullable=False), ColumnSpec("updated_at", "integer")))
    target = BucketedTable.create(spark, folder, spec, ["id"], 2)
    assert run_sync(source(spark, []), target, SYNC).status == "success"


def test_intermediate_data_is_shared(spark, monkeypatch):
    from tablesync import files

    class Unset:
        def __init__(self):
            self.sparkContext, self.conf, self.named = self, self, None

        def getConf(self):
            return {}

        def get(self, name, default=None):
            return "hdfs:///warehouse" if name == "spark.sql.warehouse.dir" else default

        def getCheckpointDir(self):
            return self.named

        def setCheckpointDir(self, path):
            self.named = path

    assert files.checkpoint_root(Unset()) == "hdfs:///warehouse/_tablesync"
