import re

import numpy as np
import pytest
import xxhash

from tablesync.llm import simhash
from tablesync.llm.components import components
from tablesync.llm.simhash import keep_one_of_each, links, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, size=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values, bits):
    values = list(values)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    return [find(k) for k in range(len(values))]


def test_against_brute_force(docs, corpus):
    found = near_duplicates(docs, 4, 4).collect()
    prints = [fingerprint(t) for _, t, _ in corpus]
    groups = grouped(prints, 4)
    least = {g: min((i for (i, _, _), h in zip(corpus, groups) if h == g and i is not None), default=None) for g in set(groups)}
    want = [(i, f"{p:016x}", least[g]) for (i, _, _), p, g in zip(corpus, prints, groups)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def planted(seed, centres, each):
    random = np.random.default_rng(seed)
    values = set(random.integers(0, 1 << 63, 400, dtype=np.uint64).tolist())
    for centre in random.integers(0, 1 << 63, centres, dtype=np.uint64).tolist():
        for _ in range(each):
            value = centre
            for bit in random.integers(0, 64, random.integers(0, 7)).tolist():
                value ^= 1 << bit
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize(("bits", "bucket"), [(4, 4096), (4, 8), (2, 4096), (6, 4096)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, bits, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = planted(bits, 6, 40)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(links(fps, bits)).collect()}
    groups = grouped(values, bits)
    mine = [roots.get(v, v) for v in signed]
    assert len(set(zip(mine, groups))) == len(set(mine)) == len(set(groups))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(300)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(41)} | {1000 + k: 1000 for k in range(300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays_whole(docs, corpus):
    kept = keep_one_of_each(docs, 4, 5)
    assert kept.columns == docs.columns
    groups = grouped([fingerprint(t, 5) for _, t, _ in corpus], 4)
    found = [r["doc_id"] for r in kept.collect()]
    want = [min((i if i is not None else 1 << 63) for (i, _, _), h in zip(corpus, groups) if h == g) for g in set(groups)]
    assert sorted(i if i is not None else 1 << 63 for i in found) == sorted(want)


def test_no_documents(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert keep_one_of_each(no_docs).count() == 0
