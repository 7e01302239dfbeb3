"""Layers above the buckets: few of them, sparse ones, and what a load reads."""

import datetime as dt
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from sync_helpers import PEOPLE, people_frame, rows
from tablesync import files
from tablesync.frames import local_frame
from tablesync.sinks import BucketedTable, bucketed, layers
from tablesync.sinks.layers import FAN, Layer, newest_to_merge
from tablesync.spec import ColumnSpec, SyncConfig, TargetSpec
from tablesync.streaming import sync_available_now

SPEC = TargetSpec(
    "t",
    (
        ColumnSpec("a", "bigint"),
        ColumnSpec("b", "text"),
        ColumnSpec("x", "bigint"),
        ColumnSpec("y", "bigint", default="-1"),
        ColumnSpec("z", "text", default="'z'"),
    ),
)


@pytest.fixture
def target(spark, folder):
    return BucketedTable.create(spark, folder, SPEC, ["a", "b"], 4)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


@pytest.mark.parametrize("sizes", ["equal", "random", "falling", "rising", "huge then small"])
def test_a_thousand_loads_leave_few_layers(sizes):
    rng, unit = random.Random(1), layers.SMALL_ROWS
    draw = {
        "equal": lambda k: unit,
        "random": lambda k: int(unit * 4 ** rng.uniform(-3, 4)),
        "falling": lambda k: unit * (1001 - k),
        "rising": lambda k: unit * (k + 1),
        "huge then small": lambda k: unit * 4**9 if k == 0 else 10,
    }[sizes]
    held, loaded, written = [], 0, 0
    for k in range(1000):
        held.append(Layer(str(k), draw(k)))
        loaded += held[-1].rows
        many = newest_to_merge(held)
        if many:
            one = Layer("m", sum(layer.rows for layer in held[-many:]))
            written += one.rows
            held[-many:] = [one]
        tiers = [layer.tier for layer in held]
        assert tiers == sorted(tiers, reverse=True)
        assert all(tiers.count(t) < FAN for t in tiers)
    assert len(held) <= (FAN - 1) * (held[0].tier + 1)
    # A row is rewritten at most once a tier, and a few times among the smallest.
    assert written <= loaded * 2 * (held[0].tier + 2)


def test_layers_of_many_sizes_against_a_dictionary(spark, target, monkeypatch):
    monkeypatch.setattr(layers, "SMALL_ROWS", 6)
    rng, model = random.Random(4), {}
    for step in range(18):
        drawn = {(rng.randrange(40), rng.choice("pq")): (rng.choice([None, rng.randrange(9)]), rng.randrange(9), rng.choice([None, "s"])) for _ in range(rng.choice([1, 3, 12, 40]))}
        df = local_frame(spark, [(*k, *v) for k, v in drawn.items()], "a bigint, b string, x bigint, y bigint, z string")
        left_out = rng.choice([[], [], ["y"], ["z"], ["y", "z"], ["x", "z"]])
        target.upsert(df.drop(*left_out))
        for k, v in drawn.items():
            old = model.get(k, (None, -1, "z"))
            model[k] = tuple(o if c in left_out else n for c, o, n in zip("xyz", old, v))
        if step == 9:
            target.compact()
            assert target.version().layers == ()
        if step % 6 == 5 or step == 9:
            assert sorted(map(tuple, target.read().collect()), key=repr) == sorted((k + v for k, v in model.items()), key=repr)
    held = target.version().layers
    assert len(held) <= (FAN - 1) * (held[0].tier + 1)
    # One scan of the buckets and two of all layers; twice the buckets where a value may have to come from there.
    assert scans(target.read()) <= 5


def test_one_scan_of_all_layers(spark, target):
    for load in range(3):
        target.upsert(local_frame(spark, [(load, "p", load, 0, "s")], "a bigint, b string, x bigint, y bigint, z string"))
    assert len(target.version().layers) == 2
    assert scans(target.read()) == 3


def test_merged_layers_are_freed(spark, target):
    for load in range(9):
        target.upsert(local_frame(spark, [(load % 3, "p", load, 0, "s")], "a bigint, b string, x bigint, y bigint, z string"))
    held = target.version()
    assert len(held.layers) < FAN
    assert target.vacuum(keep=1)
    assert {n for n in files.names(spark, target.path) if n[0] not in "_."} == held.runs
    assert rows(target.read(), "a", "x") == [(0, 6), (1, 7), (2, 8)]


def test_filters_reach_buckets_and_layers(spark, target):
    for load in range(3):
        target.upsert(local_frame(spark, [(load, "p", load, 0, "s")], "a bigint, b string, x bigint, y bigint, z string"))
    plan = target.read().filter("a = 2").select("x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(a,2)") >= plan.count("FileScan parquet") > 0


def test_a_load_without_some_columns_reads_nothing_of_the_target(spark, target, monkeypatch):
    target.upsert(local_frame(spark, [(k, "p", k, k, "s") for k in range(50)], "a bigint, b string, x bigint, y bigint, z string"))
    plans = []
    written = bucketed.stage_delta

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, *args)

    with monkeypatch.context() as patch:
        patch.setattr(bucketed, "stage_delta", spy)
        for name in ("_bucketed", "_changes", "read"):
            patch.setattr(BucketedTable, name, lambda *a, **k: pytest.fail("reads the target"))
        target.upsert(local_frame(spark, [(1, "p", None), (99, "p", None)], "a bigint, b string, y bigint"))
        target.upsert(local_frame(spark, [(1, "p", 7), (99, "p", 8)], "a bigint, b string, x bigint"))
    assert "parquet" not in "".join(plans)
    held = target.version().layers
    assert [layer.absent for layer in held] == [("x", "z"), ("y", "z")]
    found = {r["a"]: (r["x"], r["y"], r["z"]) for r in target.read().filter("a IN (1, 2, 99)").collect()}
    assert found == {1: (7, None, "s"), 2: (2, 2, "s"), 99: (8, None, "z")}
    target.compact()
    assert {r["a"]: (r["x"], r["y"], r["z"]) for r in target.read().filter("a IN (1, 2, 99)").collect()} == found


def test_a_failed_merge_of_layers_is_put_off(spark, target, monkeypatch):
    one = lambda k: local_frame(spark, [(k, "p", k, 0, "s")], "a bigint, b string, x bigint, y bigint, z string")
    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "_merged_layer", lambda *a: (_ for _ in ()).throw(OSError("no space left")))
        for load in range(7):
            assert target.upsert(one(load)).status == "success"
    assert len(target.version().layers) == 6
    target.upsert(one(7))
    assert len(target.version().layers) == 1 and target.read().count() == 8


def test_a_first_load_that_another_one_overtook(spark, target):
    early = target.stage(local_frame(spark, [(1, "p", 1, 1, "early")], "a bigint, b string, x bigint, y bigint, z string"))
    target.upsert(local_frame(spark, [(1, "p", 2, 2, "first"), (2, "p", 2, 2, "first")], "a bigint, b string, x bigint, y bigint, z string"))
    target.upsert(local_frame(spark, [(3, "p", 3, 3, "layer")], "a bigint, b string, x bigint, y bigint, z string"))
    target.load(early)
    assert rows(target.read(), "a", "z") == [(1, "early"), (2, "first"), (3, "layer")]


# -- batches side by side -----------------------------------------------------------------------


class Slow(BucketedTable):
    wait, broken = None, ()

    def _prepare(self, staged, batch):
        if batch in self.broken:
            raise ValueError("broken")
        if isinstance(self.wait, threading.Barrier):
            self.wait.wait(30)
        elif self.wait:
            time.sleep(self.wait)
        self.spark.range(10).count()


def people_of(spark, n):
    return spark.range(n).selectExpr("id", "'n' AS name", "TIMESTAMP_NTZ '2024-01-01' AS updated_at")


def test_batches_are_prepared_at_once(spark, folder):
    target = Slow.create(spark, folder, PEOPLE, ["id"], 4)
    target.wait = threading.Barrier(4)  # opens only if four batches are under way together
    summary = target.upsert(people_of(spark, 100), batches=4, batch_by=F.col("id") % 4, config=SyncConfig(max_workers=4))
    assert (summary.total_rows, summary.chunks_ok) == (100, 4)
    assert target.version().number == 1 and target.read().count() == 100


def test_eight_batches_take_less_than_half_the_time(spark, folder):
    seconds = {}
    for workers in (1, 4):
        target = Slow.create(spark, f"{folder}-{workers}", PEOPLE, ["id"], 4)
        target.wait = 0.5
        staged = target.stage(people_of(spark, 80), batches=8, batch_by=F.col("id") % 8)
        seconds[workers] = target.load(staged, config=SyncConfig(max_workers=workers)).elapsed_s
    assert seconds[4] < seconds[1] / 2


def test_a_broken_batch_stops_no_other(spark, folder):
    target = Slow.create(spark, folder, PEOPLE, ["id"], 4)
    target.broken = (2,)
    staged = target.stage(people_of(spark, 80), batches=8, batch_by=F.col("id") % 8)
    summary = target.load(staged, "people", layers_mark(), SyncConfig(max_workers=3))
    assert (summary.total_rows, summary.chunks_ok, summary.chunks_failed) == (70, 7, 1)
    assert target.read().filter("id % 8 = 2").count() == 0 and target.mark("people").last_value is None


def layers_mark():
    from tablesync.sinks import Mark

    return Mark(dt.datetime(2024, 2, 1))


# -- streams, exactly once ----------------------------------------------------------------------


class DiesAfterCommit(BucketedTable):
    at = 2

    def load(self, *args, **options):
        summary = super().load(*args, **options)
        self.at -= 1
        if self.at == 0:
            raise OSError("lost after the commit")
        return summary


def test_a_replayed_batch_is_left_out(spark, folder, tmp_path):
    arrivals, progress = str(tmp_path / "arrivals"), str(tmp_path / "progress")
    for k in range(3):
        people_frame(spark, [(k, f"n{k}", dt.datetime(2024, 1, 1), 1.0)]).coalesce(1).write.mode("append").parquet(arrivals)
    target = DiesAfterCommit.create(spark, folder, PEOPLE, ["id"], 2)

    def start(into):
        stream = spark.readStream.schema(people_frame(spark).schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
        return sync_available_now(stream, into, progress, ["updated_at"])

    with pytest.raises(Exception, match="lost after the commit"):
        start(target)
    before = target.version()
    assert list(before.streams.values()) == [1]
    assert before.bucket_rows + before.layer_rows == 2
    again = BucketedTable.open(spark, folder)
    assert start(again).total_rows == 1  # the third batch only
    after = again.version()
    assert list(after.streams.values()) == [2] and after.bucket_rows + after.layer_rows == 3
    assert rows(again.read(), "id") == [(0,), (1,), (2,)]
    other = str(tmp_path / "other")
    stream = spark.readStream.schema(people_frame(spark).schema).parquet(arrivals)
    assert sync_available_now(stream, again, other).total_rows == 3  # another stream has its own number
    assert len(again.version().streams) == 2
