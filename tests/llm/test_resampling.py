import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablesync.llm import resampling
from tablesync.llm.resampling import after_space, bucket_gains, feature_counts, features, resample

SCHEMA = "item_id long, text string, score long, n long, s string"


def plain_features(text, longest=2):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) for run in runs]


def by_hand(corpus, target, percent=25, least=20, buckets=10_000, seed=7, longest=2):
    made = [(i, *plain_features(t, longest)) for i, t in corpus]
    source, wanted = Counter(), Counter()
    for _, _, runs in made:
        source.update(r % buckets for r in runs)
    for t in target:
        wanted.update(r % buckets for r in plain_features(t, longest)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (t := 1.0) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
    rows = []
    for i, words, runs in made:
        weight = sum(gain(r % buckets) for r in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def target(texts):
    return [texts[3], texts[61], "House Tree12 \x00 x_y", None, "", "ÉÄ语 éä语"]


def targets(spark, texts):
    return spark.createDataFrame([(k, t, 5, 6, "s") for k, t in enumerate(texts)], SCHEMA).repartition(2)


@pytest.mark.parametrize("at_once, percent, buckets, longest", [(1 << 17, 25, 10_000, 2), (7, 60, 50, 2), (5, 100, 997, 3), (64, 33, 97, 1)])
def test_scores_and_ranks_by_hand(spark, docs, corpus, target, monkeypatch, at_once, percent, buckets, longest):
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", at_once)
    found = resample(docs, targets(spark, target), percent, 20, buckets, longest, seed=7)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.typeName() for f in found.schema} == {"long"}
    want = by_hand([(i, t) for i, t, _ in corpus], target, percent, 20, buckets, 7, longest)
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_equal_scores_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(resampling, "luck", lambda doc_id, seed: 3)
    rows = [(9 - k, "same words " * 12, 1, 1, "s") for k in range(9)] + [(None, "same words " * 12, 1, 1, "s")]
    docs = spark.createDataFrame(rows, SCHEMA.replace("item_id", "doc_id"))
    ranks = {r["doc_id"]: r["rank"] for r in resample(docs, targets(spark, ["other"]), percent=50).collect()}
    assert ranks == {k: k if k <= 5 else None for k in range(1, 10)} | {None: None}


def test_batches_of_texts_do_not_mix(monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choice("ab Z9_\x00é") for _ in range(r.randrange(30))) for _ in range(200)]
    for size in (1, 2, 3, 1000):
        monkeypatch.setattr(resampling, "WORDS_AT_ONCE", size)
        for longest in (1, 2, 4):
            got = Counter()
            words = np.zeros(len(texts), int)
            for owner, owners, bucket in features([t.encode() for t in texts], 1 << 32, longest):
                words += np.bincount(owner, minlength=len(texts))
                got.update(zip(owners.tolist(), bucket.tolist()))
            want = [plain_features(t, longest) for t in texts]
            assert words.tolist() == [n for n, _ in want]
            assert got == Counter((k, b) for k, (_, runs) in enumerate(want) for b in runs)


def test_checksums_after_a_space():
    some = [b"", b"a", b"word", "é".encode(), bytes(range(256))]
    assert after_space(np.array([zlib.crc32(x) for x in some], np.uint32)).tolist() == [zlib.crc32(x + b" ") for x in some]


def test_drawn_documents_look_like_the_target(spark):
    r = random.Random(3)
    like = lambda words: " ".join(r.choice(words) for _ in range(60))
    common, wanted = [f"w{k}" for k in range(300)], [f"w{k}" for k in range(250, 400)]
    rows = [(k, like(wanted if k % 5 == 0 else common), 1, 1, "s") for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA.replace("item_id", "doc_id"))
    drawn = [x["doc_id"] for x in resample(docs, targets(spark, [like(wanted) for _ in range(20)]), percent=20).collect() if x["rank"]]
    # The mean of the gains is a mild weight beside the noise: twice the share of a blind draw, 24.
    assert len(drawn) == 120 and sum(k % 5 == 0 for k in drawn) > 40


def test_empty_tables(spark, docs, no_docs, target):
    assert resample(no_docs, targets(spark, target)).count() == 0
    assert feature_counts(no_docs).sum() == 0
    assert set(bucket_gains(np.zeros(5, int), np.zeros(5, int))) == {0}
    assert resample(docs, targets(spark, [])).where("rank IS NOT NULL").count() > 0
