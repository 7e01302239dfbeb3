import hashlib
import math
import random

import numpy as np
import pytest

from tablesync.llm import codes
from tablesync.llm.codes import exact_products, limb_bits, limbs, nearest, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, entry int, of_label int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 5, 6, 7) for r in rows], SCHEMA).repartition(3)


def by_hand(rows, parts, entries, rounds):
    """Plain Python integers, one comparison at a time."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    first += sorted((k for k in range(len(kept)) if kept[k][0] is None), key=lambda k: kept[k][1])[: entries - len(first)]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign(part, book):
        distances = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(assign(c[p], books[p])[0], []).append(c[p])
            for e, members in groups.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, by_label = [], {}
    for (i, _, g), c in zip(kept, cut):
        found = [assign(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), g))
        by_label[g] = by_label.get(g, 0) + out[-1][2]
    return sorted(((i, code, error, by_label[g], digest) for i, code, error, g in out), key=repr)


def some_rows(n, width, spread=1.0):
    r = random.Random(n)
    centres = [[r.gauss(0, spread) for _ in range(width)] for _ in range(5)]
    rows = [((k * 7) % 1009, [x + r.gauss(0, 0.1) for x in centres[k % 5]], None if k % 9 == 0 else k % 3) for k in range(n)]
    odd = [(5000, None, 1), (-1, [float("nan")] * width, 1), (-2, [None] + [0.0] * (width - 1), 2), (-3, [float("-inf")] * width, None)]
    return [*rows, *odd, (None, rows[0][1], 1), rows[3], (rows[4][0], rows[5][1], 1), (9999, rows[6][1], None)]


@pytest.mark.parametrize("n, parts, entries, rounds, spread", [(150, 4, 16, 2, 1.0), (9, 2, 64, 2, 1.0), (60, 4, 8, 3, 20_000.0), (40, 4, 8, 0, 1.0)])
def test_codes_against_integers_by_hand(spark, n, parts, entries, rounds, spread):
    rows = some_rows(n, 8, spread)
    found = vector_codes(frame(spark, rows), parts, entries, rounds)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows, parts, entries, rounds)


def test_many_labels_are_joined_without_a_broadcast(spark, monkeypatch):
    rows = some_rows(60, 8)
    monkeypatch.setattr(codes, "FEW_LABELS", 1)
    assert sorted(map(tuple, vector_codes(frame(spark, rows), 4, 8, 1).collect()), key=repr) == by_hand(rows, 4, 8, 1)


@pytest.mark.parametrize("largest", [1 << 8, (1 << 25) - 1, 1 << 27, 1 << 30])
def test_products_of_limbs_are_exact(largest):
    r = np.random.default_rng(largest)
    a, b = r.integers(-largest, largest + 1, (40, 4)), r.integers(-largest, largest + 1, (4, 30))
    a[0], b[:, 0] = largest, -largest
    want = [[sum(int(x) * int(y) for x, y in zip(row, column)) for column in b.T] for row in a]
    assert exact_products(a, b).tolist() == want
    bits = limb_bits(4)
    assert 4 << (2 * bits) < 1 << 53 <= 4 << (2 * bits + 2)
    pieces = limbs(a, bits)
    assert len(pieces) == (1 if largest < 1 << bits else 2)
    assert (sum(p.astype(np.int64) << (bits * k) for k, p in enumerate(pieces)) == a).all()


def test_the_first_of_equally_near_entries():
    books = np.array([[[5, 5], [0, 0], [0, 0], [2, 0]]])
    found, errors = nearest(np.array([[[1, 0]], [[0, 0]]]), books)
    assert found.tolist() == [[1], [1]] and errors.tolist() == [[1], [0]]


def test_empty_and_refused_tables(spark):
    assert vector_codes(frame(spark, [])).count() == 0
    assert vector_codes(frame(spark, [(1, None, 1), (2, [float("nan")], 1)])).count() == 0
    for rows, message in (([(1, [1.0] * 8, 1), (1, [1.0] * 4, 1)], "components in one table|equal parts|reshape"), ([(1, [1.0] * 7, 1)], "equal parts"), ([(1, [1e30] * 8, 1)], "beyond")):
        with pytest.raises(Exception, match=message):
            vector_codes(frame(spark, rows).coalesce(1), 4).collect()
