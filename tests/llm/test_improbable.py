import hashlib
import math
from collections import Counter

import numpy as np

from tablesync.llm import improbable
from tablesync.llm.improbable import as_text, digests, edited, fingerprint_documents, likeness, rarity_table


def test_levels_follow_the_entropy_of_each_window():
    data = ("abcabc" * 9 + "Hello, world! ünïcode " * 3).encode()
    levels = improbable.entropy_levels(np.frombuffer(data, np.uint8))
    for k in range(len(data) - improbable.WINDOW + 1):
        counts = Counter(data[k : k + improbable.WINDOW]).values()
        bits = sum(n * (5 - math.log2(n)) for n in counts) / improbable.WINDOW
        assert abs(levels[k] - bits / 5 * (improbable.LEVELS - 1)) < 2


def test_against_brute_force(docs, corpus):
    found = fingerprint_documents(docs).collect()
    ranks = rarity_table(docs)
    order = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    rows = [(i, t or "") for i, t, _ in order]
    want = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        size = len(text) // 4
        new = text[: len(text) - size] + after[:size]
        own, changed, following = (digests([t.encode()], ranks)[0] for t in (text, new, after))
        want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, following)))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_edits_stay_near_and_others_far(docs):
    rows = [r for r in fingerprint_documents(docs).collect() if r["n_chars"] > 800 and r["near_edited"] < 1]
    assert len(rows) > 20
    assert np.mean([r["near_edited"] for r in rows]) > 0.6
    assert np.mean([r["near_next"] for r in rows]) < 0.3


def test_likeness_of_odd_texts():
    ranks = np.arange(improbable.LEVELS)
    empty, short, other, same = digests([b"", b"tiny", b"a tiny one", b"tiny"], ranks)
    assert likeness(empty, empty) == 1 and likeness(empty, short) == 0
    assert likeness(short, same) == 1 and likeness(short, other) < 0.5
    assert edited("abcdefgh", "x") == "abcdefx" and edited("", "x") == ""


def test_a_digest_does_not_depend_on_its_neighbours(texts):
    data = [(t or "").encode() for t in texts]
    ranks = improbable.rarity(improbable.level_counts(data))
    together = [as_text(c) for c in digests(data, ranks)]
    assert together == [as_text(digests([t], ranks)[0]) for t in data]


def test_one_and_no_document(spark, no_docs):
    one = spark.createDataFrame([(4, "some text of a document " * 9)], "doc_id long, text string")
    row = fingerprint_documents(one).first()
    assert row["near_next"] == 1 and row["doc_id"] == 4
    assert fingerprint_documents(no_docs).count() == 0
