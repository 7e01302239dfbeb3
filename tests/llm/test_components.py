import os
import random

import pytest

from tablesync.llm import common, components, widehash


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """As on the table with large groups: many partitions after a shuffle, none put together; the folder of the stored tables."""
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    monkeypatch.setattr("tablesync.files.checkpoint_root", lambda spark: str(tmp_path / "shared"))
    for name, value in held.items():
        spark.conf.set(name, value)
    yield str(tmp_path / "shared")
    for name, value in before.items():
        spark.conf.set(name, value)


def parts(folder):
    """Files with rows of each stored table."""
    return {name: sum(x.startswith("part-") for x in os.listdir(f"{folder}/{name}")) for name in os.listdir(folder)}


def roots_of(edges):
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root}


@pytest.mark.parametrize("each", [1 << 14, 7])
def test_rounds_are_laid_out_for_their_edges(spark, shared, monkeypatch, each):
    monkeypatch.setattr(common.gathered, "__defaults__", (each,))
    r = random.Random(11)
    edges = [(k, k + 1) for k in range(60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)]
    edges = [(a, b) for a, b in edges if a != b]
    found = components.components(spark.createDataFrame(edges, "a long, b long").repartition(24), len(edges))
    assert {x["node"]: x["root"] for x in found.collect()} == roots_of(edges)
    files = parts(shared)
    assert len(files) > 3 and (max(files.values()) == 1 if each > 1000 else max(files.values()) > 5)


def test_small_tables_of_the_search_are_few_files(spark, shared):
    r = random.Random(12)
    texts = []
    for _ in range(60):
        words = [f"w{r.randrange(10**6)}" for _ in range(80)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = sorted(x["doc_id"] for x in widehash.keep_one_of_similar(docs).collect())
    assert kept == list(range(0, 120, 2))
    files = {name: n for name, n in parts(shared).items() if not name.startswith("components")}
    assert len(files) > 10 and all(n <= 3 for n in files.values()), files
