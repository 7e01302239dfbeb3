import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablesync.llm.mixing import mix_sources, mixed_documents, source_targets


def targets(sizes, weights, most):
    """Shares by weight; what is above a cap is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    fixed, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] >= most * sizes[n]}
        if not over:
            return fixed | share
        fixed |= {n: float(most * sizes[n]) for n in over}
        free -= over


def test_sources_meet_their_targets(docs, corpus):
    rows = mix_sources(docs, (1, 2, 3), 3).collect()
    assert len(rows) == len(corpus)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    words = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in corpus]
    assert sorted(((r["doc_id"], r["size"]) for r in rows), key=repr) == sorted(words, key=repr)
    want = targets(sizes, (1, 2, 3), 3)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_reruns_agree_and_order_is_by_key(docs):
    first = sorted(map(tuple, mix_sources(docs).collect()), key=repr)
    assert first == sorted(map(tuple, mix_sources(docs.repartition(5)).collect()), key=repr)
    assert first != sorted(map(tuple, mix_sources(docs, seed=8).collect()), key=repr)


def test_better_documents_are_taken_first(spark):
    rows = [(k, " ".join(["w"] * 10), "a" if k < 2000 else "b", 0.9 if k % 2 else 0.1) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, q double")
    found = mix_sources(docs, (1, 9), 3, quality=F.col("q"))
    share = {r["quality"]: r["t"] for r in found.where("source = 'a'").groupBy("quality").agg(F.sum("taken").alias("t")).collect()}
    assert share[0.9] > 2.5 * share[0.1]


@pytest.mark.parametrize("sizes", [{"a": 5, "b": 1000, "c": 1000, None: 1}, {"a": 0, "b": 7}, {None: 4}, {"z": 1, "y": 1, "x": 90, "w": 2}])
def test_targets_against_resharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "skey string, source_size long")
    found = {r["skey"]: r["target"] for r in source_targets(frame, (1, 2, 3), 3).collect()}
    assert found == {k: pytest.approx(v) for k, v in targets(sizes, (1, 2, 3), 3).items()}


def test_mixed_documents_are_whole(docs, corpus):
    rows = mixed_documents(docs).collect()
    assert {(r["doc_id"], r["text"], r["source"]) for r in rows} <= set(corpus) and rows[0].asDict().keys() == set(docs.columns)
    sums = {}
    for r in mix_sources(docs, cut_last=False).collect():
        assert r["taken"] % max(r["size"], 1) == 0
        sums.setdefault(r["source"], [0, r["target"], 0])
        sums[r["source"]][0] += r["taken"]
        sums[r["source"]][2] = max(sums[r["source"]][2], r["size"])
    assert all(abs(t - want) <= most for t, want, most in sums.values())


def test_no_documents(no_docs):
    assert mix_sources(no_docs).count() == 0
    assert mixed_documents(no_docs).columns == no_docs.columns
