import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tablesync.llm import sharding
from tablesync.llm.sharding import shard_by_bytes


def smallest_capacity(sizes, shards):
    def needed(capacity):
        count, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return shards + 1
            if size > room:
                count, room = count + 1, capacity
            room -= size
        return count

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize(("shards", "points"), [(24, 8192), (4, 8192), (7, 16), (1, 16)])
def test_against_brute_force(docs, corpus, monkeypatch, shards, points):
    """With few points the search looks at the table many times."""
    monkeypatch.setattr(sharding, "POINTS", points)
    rows = shard_by_bytes(docs, shards).collect()
    data = [(i, (t or "").encode()) for i, t, _ in corpus]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["doc_id"] is not None) == sorted((i, len(b) + 8, zlib.crc32(b)) for i, b in data if i is not None)
    groups = defaultdict(int)
    for _, b in data:
        groups[hashlib.sha256(b).hexdigest()] += len(b) + 8
    capacity = smallest_capacity([groups[k] for k in sorted(groups)], shards)
    place, shard, room = {}, 0, capacity
    for key in sorted(groups):
        if groups[key] > room:
            shard, room = shard + 1, capacity
        room -= groups[key]
        place[key] = shard
    assert all(r["shard"] == place[r["text_sha256"]] for r in rows) and len(rows) == len(data)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_those_of_the_greedy_pass(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "POINTS", 24)
    r = random.Random(seed)
    sizes = [r.choice([1, 2, 3, 50, r.randrange(1, 4000)]) for _ in range(400)]
    ends = [sum(sizes[: k + 1]) for k in range(len(sizes))]
    frame = spark.createDataFrame([(e,) for e in ends], "end long").cache()
    shards = r.choice([2, 5, 9])
    cuts = sharding.cut_places(frame, ends[-1], max(sizes), shards)
    capacity, want, at = smallest_capacity(sizes, shards), [], 0
    for _ in range(shards):
        at = max(e for e in [at, *ends] if e <= at + capacity)
        want.append(at)
    assert cuts == want


def test_no_documents(no_docs):
    assert shard_by_bytes(no_docs).count() == 0
