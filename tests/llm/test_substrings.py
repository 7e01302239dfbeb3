import hashlib
import re

import pytest

from tablesync.llm import substrings
from tablesync.llm.substrings import dedup_substrings, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(corpus, window):
    first, words = {}, [WORD.findall(t or "") for _, t, _ in corpus]
    ids = [float("inf") if i is None else i for i, _, _ in corpus]
    for i, some in zip(ids, words):
        for k in range(len(some) - window + 1):
            key = tuple(some[k : k + window])
            first[key] = min(first.get(key, i), i)
    rows = []
    for (own, _, _), i, some in zip(corpus, ids, words):
        gone = [False] * len(some)
        for k in range(len(some) - window + 1):
            if first[tuple(some[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = [w for w, g in zip(some, gone) if not g]
        rows.append((own, len(some), len(some) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("window", "cell"), [(13, 20_000), (13, 10), (5, 20_000)])
def test_against_brute_force(docs, corpus, monkeypatch, window, cell):
    """With a small cell all repeated passages take the way of hot minimisers."""
    monkeypatch.setattr(substrings, "SMALL_CELL", cell)
    found = dedup_substrings(docs, window).collect()
    assert sorted(map(tuple, found), key=repr) == expected(corpus, window)


def test_equal_hashes_are_told_apart_by_text(monkeypatch):
    import numpy as np

    texts = [b"a b c d", b"x y z", b"a b c", b"x y z"]
    want = substrings.covered_windows(np.array([4, 3, 2, 9]), np.array([4, 3, 3, 3]), texts, 3)
    monkeypatch.setattr(substrings, "_window_hashes", lambda hashes, at, window: np.zeros(len(at), np.uint64))
    found = substrings.covered_windows(np.array([4, 3, 2, 9]), np.array([4, 3, 3, 3]), texts, 3)
    assert found.tolist() == want.tolist() == [True, False, False, False, True]


def test_rows_keep_their_columns_and_white_space(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, f"start\n{passage}\tend", 9, 0), (2, f"Mine:\n\n first {passage} last\tword", 9, 0), (3, passage, 9, 0), (4, "as  it\nis", 9, 0), (5, None, 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, n_chars long")
    found = {r["doc_id"]: r for r in without_repeats(docs).collect()}
    assert set(found) == {1, 2, 4, 5} and found[1]["id"] == 9
    assert found[1]["text"] == rows[0][1] and found[4]["text"] == "as  it\nis" and found[5]["text"] is None
    assert found[2]["text"] == "Mine:\n\n first\nlast\tword" and found[2]["n_chars"] == len(found[2]["text"])
    assert found[1]["n_chars"] == found[4]["n_chars"] == 0 and found[5]["n_chars"] is None


def test_no_documents(no_docs):
    assert dedup_substrings(no_docs).count() == 0
    assert without_repeats(no_docs).columns == no_docs.columns


def test_null_ids_with_digests_alike_keep_their_own_words(spark):
    """Two texts whose hashes agree in the upper 32 bits: only the one with an earlier passage loses it."""
    import xxhash

    passage, other = " ".join(f"p{k}" for k in range(20)), " ".join(f"q{k}" for k in range(20))
    upper = {xxhash.xxh64_intdigest(f"{passage} a{k}", 42) >> 32: f"{passage} a{k}" for k in range(300_000)}
    one, two = next((upper[h], t) for t in (f"{other} b{k}" for k in range(300_000)) if (h := xxhash.xxh64_intdigest(t, 42) >> 32) in upper)
    docs = spark.createDataFrame([(1, passage), (None, one), (None, two)], "doc_id long, text string")
    found = {(r["doc_id"], r["n_words"] - r["n_removed"]) for r in dedup_substrings(docs).collect()}
    assert found == {(1, 20), (None, 1), (None, 21)}


def test_spans_of_rows_alike_are_there_once(spark, monkeypatch):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = spark.createDataFrame([(1, passage)] + [(2, passage + " more")] * 50, "doc_id long, text string")
    held = []
    monkeypatch.setattr(substrings, "map_batches", lambda rows, f, s, g=substrings.map_batches: (held.append(rows), g(rows, f, s))[1])
    assert {(r["doc_id"], r["n_removed"]) for r in dedup_substrings(docs).collect()} == {(1, 0), (2, 20)}
    assert all(len(r["spans"] or ()) == len(set(r["spans"] or ())) for rows in held if "spans" in rows.columns for r in rows.collect())
