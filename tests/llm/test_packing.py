import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablesync.llm.packing import PLAIN_BYTES, PieceIds, WordIds, pack_documents, packing_plan

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_against_the_library(docs, corpus):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, text, _ in corpus:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, a // 512, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes())) for a in range(0, len(ids), 512)]
    rows = pack_documents(docs, PATH, 512, with_ids=True).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 512
    assert len(places) <= sum(r["length"] for r in rows) / 512 * 1.05 + 1


def test_words_have_the_ids_of_the_library():
    tokenizer, words, r = Tokenizer.from_file(PATH), WordIds(PATH), random.Random(2)
    odd = [chr(c) for c in range(0x20, 0x180)] + list("ΣσİßẞéÀ語😀\t\n") + ["'re", "'LL", "<|endoftext|>", "<|start", "\x1c", "\x85", "á"]
    for _ in range(3000):
        text = "".join(r.choice(odd) for _ in range(r.randrange(12)))
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert b"".join(words[w] for w in text.encode().split()) == want, repr(text)


def test_texts_have_the_ids_of_the_library():
    """Plain texts are split into pieces at once: their words are not looked up, and fewer pieces than words are kept."""
    tokenizer, words, r = Tokenizer.from_file(PATH), WordIds(PATH), random.Random(3)
    plain = [chr(b) for b in PLAIN_BYTES] + list("'srtmdlve 're'll  ")
    for odd in ("", "ΣσİẞÀ語😀\x1c\x85\xa0\xad\u0301"):
        for _ in range(3000):
            text = "".join(r.choice(plain + list(odd) * 3) for _ in range(r.randrange(40)))
            text = text + r.choice(["", " <|endoftext|>", "<|"]) if odd else text.replace("<|", "|<")
            want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert words.of_text(text.encode()) == want, repr(text)
        assert bool(words) == bool(odd)
    words, some = WordIds(PATH), [f"{w}{end}" for w in ("House", "tree", "écran", "x1") for end in ("", ",", ".", ").", "'s", "!!", "-")]
    assert words.of_text(" ".join(some).encode()) and not words and len(words.pieces) < len(some)


def test_pieces_go_in_turn():
    asked = []
    pieces = PieceIds(lambda piece: asked.append(piece) or piece.encode(), 3)
    for _ in range(2):
        assert [pieces[p] for p in "abcdeab"] == [p.encode() for p in "abcdeab"]
    assert asked[:5] == list("abcde") and len(pieces) <= 3 and len(pieces.older) <= 3


@pytest.mark.parametrize("seed", range(6))
def test_a_plan_uses_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 4096])
    lengths = [min(capacity, 1 + int(r.expovariate(4 / capacity))) for _ in range(r.randrange(1, 3000))]
    plan = packing_plan(Counter(lengths), capacity)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(pattern) <= capacity
        for size in pattern:
            used[size] += times
    assert used == Counter(lengths)
    least = -(-sum(lengths) // capacity)
    assert least <= sum(n for _, n in plan) <= least * 1.05 + 2


def test_exact_complements_come_first():
    plan = packing_plan({7: 2, 3: 2, 6: 1, 2: 2, 5: 1, 4: 1, 1: 1}, 10)
    assert sum(n for _, n in plan) == 4 and plan[0] == ((7, 3), 2)


def test_no_documents(no_docs):
    assert packing_plan({}, 10) == []
    assert pack_documents(no_docs, PATH).count() == 0
