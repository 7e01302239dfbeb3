from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, part int, row string, key string, size string, length string"
PARTS = ["the", "of", "and", "house", "tree", "Écran", "straße", "running", "123", "x,", "(y)", "don't", "語", "a-b", "END."]


def sentence(random_, words):
    return " ".join(random_.choice(PARTS) + str(random_.randrange(60)) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Odd and ordinary texts: null, empty, white space only, short, long, copies, near copies, shared passages."""
    r = random.Random(5)
    some = [sentence(r, r.randrange(20, 200)) for _ in range(60)]
    passage = sentence(r, 60)
    some += [f"{sentence(r, 30)}\n{passage}\t{sentence(r, 20)}" for _ in range(6)]
    some += [some[3], some[3], some[4] + " more", some[5].replace("the", "thy", 1), some[6].upper()]
    some += [None, "", " \n\t ", "one", "one two three", "word " * 3000, "z" * 40_000, sentence(r, 9_000)]
    some += ["a b\n" * 40 + sentence(r, 60), "*** %% # " * 60, None, ""]
    return some


def frame(spark, rows):
    """Documents with columns whose names the operators use inside, too."""
    filled = [(i, t, "en", s, None if t is None else len(t), 7, 1, "r", "k", "s", "l") for i, t, s in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def corpus(texts):
    """(doc_id, text, source): ids not in order, one null, one row there twice, a hot and a null source."""
    rows = [((k * 37) % 101, t, None if k % 11 == 0 else "hot" if k % 3 else f"s{k % 5}") for k, t in enumerate(texts)]
    return [*rows, (None, texts[2] + " extra", "hot"), rows[7], (-5, texts[8], "s1")]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
