import random
import re
from collections import Counter

import numpy as np

from tablesync.llm import quality
from tablesync.llm.quality import calibrated, judge_documents, kept_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    within = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(within) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(within), failed


def test_statistics_against_brute_force(spark, docs, corpus):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found = judge_documents(docs, labels).select(*names).collect()
    want = [(i, *(b := base(t)), not b[-1]) for i, t, _ in corpus]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def labelled(r, n):
    """Ordinary texts, and three kinds of odd ones that pass the base rules."""
    words = ["house", "tree", "garden", "running", "slowly", "blue", "window", "seven", "letters", "and", "the", "of"]
    rows = []
    for k in range(n):
        some = [r.choice(words) + r.choice(["", "s", "ed"]) + str(r.randrange(9)) for _ in range(r.randrange(60, 300))]
        bad = k % 5 == 0
        if bad and k % 3 == 0:
            some = [w + "***" for w in some]
        elif bad and k % 3 == 1:
            some = [w.upper() + "!!" for w in some]
        elif bad:
            some = [x for w in some for x in (w, "|")]
        rows.append((k, "\n".join(" ".join(some[a : a + 12]) for a in range(0, len(some), 12)), int(not bad)))
    return rows


def test_held_out_rows(spark):
    rows = labelled(random.Random(1), 600)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t, _ in rows], "doc_id long, text string, score string, kept int")
    known = [(k, q, 0) for k, _, q in rows if k % 2] + [(None, 1, 0), (1, None, 0), (77_777, 0, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in judge_documents(docs, labels).collect()}
    clean = [kept[k] for k, _, q in rows if q and not k % 2]
    odd = [kept[k] for k, _, q in rows if not q and not k % 2]
    assert np.mean(clean) >= 0.97 and np.mean(odd) <= 0.1
    whole = kept_documents(docs, labels)
    assert whole.columns == docs.columns
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(k for k, v in kept.items() if v)


def test_sample_of_labelled_rows_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "calibrated", lambda stats, good, *_: seen.append(len(stats)))
    rows = labelled(random.Random(2), 40)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q, 0) for k, _, q in rows], "doc_id long, quality int, toxic int")
    judge_documents(docs, labels, sample_rows=10).collect()
    assert seen == [10]


def test_labels_of_one_kind_give_no_forest():
    stats = np.array([quality.statistics_of(t.encode()) for _, t, q in labelled(random.Random(3), 50) if q])
    assert calibrated(stats, np.ones(len(stats), bool), 0.99, 1) is None


def test_no_documents(spark, no_docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert judge_documents(no_docs, labels).count() == 0
    assert kept_documents(no_docs, labels).count() == 0


def test_forest_is_fitted_on_all_labelled_rows(spark):
    """More rows than any bounded sample: ranks, rows in the leaves and the threshold against numpy on all of them."""
    random = np.random.default_rng(4)
    stats = random.integers(60, 400, (21_003, len(quality.STATISTICS)))
    stats[:, 4] = random.integers(0, 20, len(stats))
    bad = np.arange(len(stats)) % 7 == 0
    stats[bad, 2] += 300
    rows = [(k, *map(int, row)) for k, row in enumerate(stats)]
    frame = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} long" for n in quality.STATISTICS)).repartition(4)
    labels = spark.createDataFrame([(k, int(not b)) for k, b in enumerate(bad.tolist())], "doc_id long, quality int")
    forest = quality.fit_forest(frame, labels)
    values = quality.features(stats)
    half = np.array([r[0] % 2 == 0 for r in frame.selectExpr("xxhash64(id) as h", "id").orderBy("id").collect()])
    fit = ~bad & half
    want = quality.grow(values[fit], values, 11)
    assert all((a == b).all() for a, b in zip(forest.knots, want.knots, strict=True))
    assert (forest.feature == want.feature).all() and (forest.path == want.path).all() and forest.rows == fit.sum()
    threshold = quality.threshold_of(want.scores(values[~fit]), ~bad[~fit], 0.99)
    assert forest.threshold == threshold
