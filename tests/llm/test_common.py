import pyarrow as pa

from tablesync.llm import common


def test_a_worker_gives_free_memory_back_at_the_end_of_a_task(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(common, "release_memory", lambda: seen.append("released"))

    class Frame:
        sparkSession = spark

        def mapInArrow(self, function, schema):
            return function

    task = common.map_batches(Frame(), lambda columns: seen.append("batch") or columns, "id long")
    batch = pa.RecordBatch.from_pydict({"id": [1, 2]})
    assert [b.num_rows for b in task(iter([batch, batch]))] == [2, 2] and seen == ["batch", "batch", "released"]


def test_memory_is_released():
    common.release_memory()
