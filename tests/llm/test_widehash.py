import random

import numpy as np
import pytest

from tablesync.llm import simhash, widehash
from tablesync.llm.widehash import keep_one_of_similar, most_bits, shingle_hashes, wide_fingerprints_of


def jaccard(a, b, size=5):
    sets = []
    for text in (a, b):
        words = text.lower().split()
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def family(r, words, edits, copies):
    base = [f"w{r.randrange(5000)}" for _ in range(words)]
    some = [base]
    for _ in range(copies):
        changed = list(base)
        for _ in range(edits):
            changed[r.randrange(words)] = f"x{r.randrange(10**6)}"
        some.append(changed)
    return [" ".join(s) for s in some]


@pytest.mark.parametrize("small", [32, 3])
def test_similar_documents_go_and_others_stay(spark, monkeypatch, small):
    monkeypatch.setattr(widehash, "SMALL", small)
    r = random.Random(3)
    groups = [family(r, r.randrange(80, 400), 2, 6) for _ in range(40)] + [family(r, 120, 0, 1) for _ in range(150)]
    texts = [t for g in groups for t in dict.fromkeys(g)]
    rows = [(k, t, k % 7) for k, t in enumerate(texts)] + [(5000, texts[0], 1), (5000, texts[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int").repartition(4)
    kept = {r["doc_id"] for r in keep_one_of_similar(docs).collect()}
    at, pairs, missed = 0, 0, 0
    for g in groups:
        own = list(dict.fromkeys(g))
        assert at in kept
        for k in range(1, len(own)):
            if jaccard(own[0], own[k]) >= 0.8:
                pairs += 1
                missed += at + k in kept
        at += len(own)
    assert pairs > 100 and missed <= 0.03 * pairs and 5000 not in kept


def test_unlike_documents_all_stay(spark):
    r = random.Random(4)
    docs = spark.createDataFrame([(k, " ".join(f"w{r.randrange(300)}" for _ in range(200))) for k in range(300)], "doc_id long, text string")
    assert keep_one_of_similar(docs).count() == 300


def test_distance_follows_similarity():
    r = random.Random(5)
    a, b = family(r, 400, 8, 1)
    one, two = wide_fingerprints_of([shingle_hashes(t.encode(), 5) for t in (a, b)])
    share = np.bitwise_count(one ^ two).sum() / widehash.BITS
    assert abs(share - np.arccos(2 * jaccard(a, b) / (1 + jaccard(a, b))) / np.pi) < 0.06
    assert not wide_fingerprints_of([shingle_hashes(t, 5) for t in (b"", b" \n")]).any() and most_bits(1.0) == 0


def test_odd_documents(docs, corpus, no_docs):
    kept = keep_one_of_similar(docs)
    assert kept.columns == docs.columns and keep_one_of_similar(no_docs).count() == 0
    found = [r["doc_id"] for r in kept.collect()]
    assert len(found) == len(set(found)) and -5 in found
    empty = [i for i, t, _ in corpus if i is not None and not (t or "").split()]
    assert [i for i in found if i in empty] == [min(empty)]


def near_the_limit(r, words, low, high):
    """Two texts whose similarity lies between ``low`` and ``high``."""
    while True:
        a = [f"w{r.randrange(10**6)}" for _ in range(words)]
        b = list(a)
        while jaccard(" ".join(a), " ".join(b)) > high:
            b[r.randrange(words)] = f"x{r.randrange(10**6)}"
        if jaccard(" ".join(a), " ".join(b)) >= low:
            return " ".join(a), " ".join(b)


def test_pairs_at_the_limit_are_found_and_those_below_stay(spark):
    r = random.Random(6)
    alike = [near_the_limit(r, 300, 0.8, 0.83) for _ in range(150)]
    unlike = [near_the_limit(r, 300, 0.7, 0.79) for _ in range(150)]
    texts = [t for pair in alike + unlike for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in keep_one_of_similar(docs).collect()}
    missed = sum(2 * k + 1 in kept for k in range(150))
    assert missed <= 1 and kept >= {2 * k for k in range(150)} | set(range(300, 600))


def test_chances_do_not_depend_on_the_number_of_documents():
    assert widehash.MISSED < 1e-4
    r = random.Random(7)
    pairs = [near_the_limit(r, 300, 0.8, 0.81) for _ in range(300)]
    keys = widehash.least_hashes_of([shingle_hashes(t.encode(), 5) for pair in pairs for t in pair])
    assert sum(not np.intersect1d(keys[2 * k], keys[2 * k + 1]).size for k in range(300)) <= 1


def test_large_group_is_found_in_blocks(spark, monkeypatch):
    """Near copies of one template and chains, with blocks far smaller than the group, against brute force."""
    monkeypatch.setattr(widehash, "SMALL", 16)
    r = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(120):
        some = list(base)
        for _ in range(r.randrange(1, 5)):
            some[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(some))
    texts = list(dict.fromkeys(texts))
    root = list(range(len(texts)))
    find = lambda k: k if root[k] == k else find(root[k])
    for a in range(len(texts)):
        for b in range(a):
            if jaccard(texts[a], texts[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in keep_one_of_similar(docs).collect()}
    assert kept == {k for k in range(len(texts)) if find(k) == k}


def test_simhash_links_give_candidates(spark, monkeypatch):
    """Without any key from least hashes, texts within four bits are found, and the exact index still decides."""
    monkeypatch.setattr(widehash, "least_hashes_of", lambda every_hash: [np.zeros(0, np.int64)] * len(every_hash))
    r = random.Random(9)
    texts = []
    for _ in range(100):
        words = [f"w{r.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    texts += [t for _ in range(50) for t in near_the_limit(r, 40, 0.5, 0.79)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in keep_one_of_similar(docs).collect()}
    found = simhash.fingerprints_of([t.encode() for t in texts], 5)
    near = {2 * k + 1 for k in range(100) if np.bitwise_count(found[2 * k] ^ found[2 * k + 1]) <= 4}
    assert len(near) >= 90 and kept == set(range(len(texts))) - near


def test_batches_are_bounded(spark, monkeypatch):
    """A partition of long texts never comes to Python at once; the setting is as before afterwards."""
    whole = widehash.encoded

    def counted(column):
        assert column.nbytes < 1 << 20, column.nbytes
        return whole(column)

    monkeypatch.setattr(widehash, "encoded", counted)
    monkeypatch.setattr(widehash, "BATCH_BYTES", 1 << 18)
    r = random.Random(10)
    base = " ".join(f"w{r.randrange(10**6)}" for _ in range(2000))
    docs = spark.createDataFrame([(k, f"{base} x{k}") for k in range(200)], "doc_id long, text string").coalesce(1)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    assert [r["doc_id"] for r in keep_one_of_similar(docs).collect()] == [0]
    assert spark.conf.get(name, None) == before


def test_fingerprints_are_those_of_operator_2():
    texts = [b"", b"one two", b" ".join(b"w%d" % k for k in range(300)), b"\n"]
    hashes = [shingle_hashes(t, 5) for t in texts]
    assert (simhash.fingerprints_of_hashes(hashes) == simhash.fingerprints_of(texts, 5)).all()
