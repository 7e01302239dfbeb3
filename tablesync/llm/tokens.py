"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable
from functools import lru_cache
from operator import sub

import ahocorasick
import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import byte_characters, map_batches

# The split rule of byte-level tokenizers and the characters it takes as white space.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: White space and what follows it up to the next white space: how it splits depends on nothing outside.
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter(dict):
    """Steps of the token count over the code points of a unit, computed once per distinct unit.

    For a piece of text that is not split further, the encoding of each prefix ends in the one token that
    lies there and agrees with the last token of the encoding before it: two neighbours agree if
    encoding their joined bytes gives the same two tokens. So the last token at every position follows from those at earlier
    positions, in one pass, and the count is that of the earlier position plus one.
    """

    #: Distinct units kept per Python worker, twice; older ones go first, results do not change.
    LIMIT = 200_000
    NONE = 1 << 40

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        shown = byte_characters()
        to_bytes = lambda token: bytes(shown[c] for c in token)
        self.names = sorted({to_bytes(token) for token in spec["model"]["vocab"]})
        number = {token: k for k, token in enumerate(self.names)}
        count = len(number)
        #: How each token is made: rank of its merge (-1: a single byte) and its two parts.
        self.rank, self.left, self.right = [-1] * count, [-1] * count, [-1] * count
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = map(to_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            made = number[a + b]
            self.merges[number[a] << 20 | number[b]] = rank
            self.rank[made], self.left[made], self.right[made] = rank, number[a], number[b]
        self.finder = ahocorasick.Automaton()
        for token, k in number.items():
            if len(token) == 1 or self.rank[k] >= 0:
                self.finder.add_word(token.decode("latin-1"), (k, len(token)))
        self.finder.make_automaton()
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.cut_specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.agree: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}

    def _agrees(self, before: int, token: int) -> bool:
        """Whether no merge crosses the border of two tokens.

        The parts at the border grow as merges are applied by rank. Going back from the whole tokens, a merge of the two
        parts there would cross if its rank comes before those that take the parts in; of equal merges the left one is first.
        """
        x, y, taken_x, taken_y = before, token, self.NONE, self.NONE
        while True:
            crossing = self.merges.get(x << 20 | y)
            if crossing is not None and crossing < taken_x and crossing <= taken_y:
                return False
            made_x, made_y = self.rank[x], self.rank[y]
            if made_x < 0 and made_y < 0:
                return True
            if made_x > made_y:
                taken_x, x = made_x, self.right[x]
            else:
                taken_y, y = made_y, self.left[y]

    def counts(self, piece: str) -> list[int]:
        """The token count of every byte prefix, the empty one first; the bytes are given as Latin-1 characters."""
        counts, last, agree = [0], [0], self.agree
        for end, (token, size) in self.finder.iter(piece):  # by end, the longest first
            if end < len(counts) - 1:
                continue
            start = end + 1 - size
            if start:
                key = last[start] << 20 | token
                fits = agree.get(key)
                if fits is None:
                    if len(agree) > 400_000:
                        agree.clear()
                    fits = agree[key] = self._agrees(last[start], token)
                if not fits:
                    continue
            counts.append(counts[start] + 1)
            last.append(token)
        if len(counts) != len(piece) + 1:
            raise ValueError("the vocabulary lacks a byte")
        return counts

    def _at_characters(self, text: str) -> list[int]:
        if text.isascii():
            return self.counts(text)
        counts = self.counts(text.encode().decode("latin-1"))
        at, places = 0, [0]
        for character in text:
            at += len(character.encode())
            places.append(at)
        return [counts[p] for p in places]

    def unit_counts(self, unit: str) -> list[int]:
        """The token count of every prefix of a unit, in code points, the empty one first."""
        if unit.isalpha() or (unit[0] == " " and unit[1:].isalpha()):
            return self._at_characters(unit)
        body = unit.lstrip(_WHITE_CHARACTERS)
        blank = len(unit) - len(body)
        counts = self._at_characters(unit[:blank])
        at, total = 0, 0
        for piece in SPLIT.findall(unit):
            inside = self._at_characters(piece)
            if piece in LONG_CONTRACTIONS:
                inside[2] = 2  # an apostrophe and a letter are two pieces until the third character
            counts += [total + n for n in inside[max(1, blank + 1 - at) :]]
            at += len(piece)
            total += inside[-1]
        if not body:
            return counts[: blank + 1]
        return counts

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        steps = self.older.get(unit)
        if steps is None:
            counts = self.unit_counts(unit)
            steps = np.diff(counts).astype("<i2").tobytes() if len(counts) > 40 else _STEPS[len(counts)](*map(sub, counts[1:], counts))
        self[unit] = steps
        return steps

    def steps(self, text: str) -> np.ndarray:
        """How the token count changes with each code point of a whole text."""
        if self.cut_specials is None or not self.cut_specials.search(text):
            return np.frombuffer(b"".join(map(self.__getitem__, UNIT.findall(text))), "<i2")
        parts, at = [], 0
        for found in self.cut_specials.finditer(text):
            before = text[at : found.start()]
            closed = int(self.steps(before).sum()) if before else 0
            # Up to its last character the special string is ordinary text.
            ordinary = self._ordinary(before + found.group()[:-1])
            parts += [ordinary, np.array([closed + 1 - int(ordinary.sum())], "<i2")]
            at = found.end()
        parts.append(self.steps(text[at:]))
        return np.concatenate(parts)

    def _ordinary(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, UNIT.findall(text))), "<i2")


_STEPS = [struct.Struct(f"<{max(0, n - 1)}h").pack for n in range(41)]
_WHITE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c)))


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_token_counts(
    docs: DataFrame,
    tokenizer: str,
    budgets: Iterable[int] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_steps: bool = True,
) -> DataFrame:
    """The token count of every whole text and of each of its prefixes, for a byte-level BPE file.

    Returns ``id_col``, n_chars, n_bytes, n_tokens, for each budget ``b`` the column ``chars_b`` (code points of the
    longest prefix with at most ``b`` tokens) and, with ``keep_steps``, ``prefix_steps``: little-endian 16-bit changes
    of the count, one per code point, so that ``tokens_at`` and ``longest_prefix`` answer
    later questions without encoding again. Counts are those of the tokenizer's library without added
    tokens; a special token's string in a text is that token.

    Defined cases: a null text counts as empty (0 tokens); repeated rows and null ids give a row each; an
    empty table gives no rows; other columns are not looked at. Work is per distinct unit (white space and
    the word after it), kept in a cache of bounded size per worker; no shuffle.
    """
    limits = tuple(budgets)
    schema = "id long, n_chars long, n_bytes long, n_tokens long" + "".join(f", chars_{b} long" for b in limits)
    schema += ", prefix_steps binary" if keep_steps else ""

    def count(columns: dict) -> dict:
        known = counter(tokenizer)
        out: dict[str, list] = {name.split()[0]: [] for name in schema.split(", ")}
        out["id"] = columns["id"]
        for value in columns["text"].to_pylist():
            text = value or ""
            steps = known.steps(text)
            tokens = int(steps.sum(dtype=np.int64))
            out["n_chars"].append(len(text))
            out["n_bytes"].append(len(text) if text.isascii() else len(text.encode()))
            out["n_tokens"].append(tokens)
            for b in limits:
                out[f"chars_{b}"].append(len(text) if tokens <= b else _longest(steps, b))
            if keep_steps:
                out["prefix_steps"].append(steps.tobytes())
        return out

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, count, schema).withColumnRenamed("id", id_col)


def _longest(steps: np.ndarray, budget: int) -> int:
    fits = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def tokens_at(steps_col: str, chars_col: str) -> Column:
    """The exact token count of the first ``chars_col`` code points of each row."""

    @F.pandas_udf("long")
    def answer(steps, chars):
        return steps.combine(chars, lambda s, k: int(np.frombuffer(s, "<i2", count=min(k, len(s) // 2)).sum(dtype=np.int64)))

    return answer(F.col(steps_col), F.col(chars_col))


def longest_prefix(steps_col: str, budget: int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def answer(steps):
        return steps.map(lambda s: _longest(np.frombuffer(s, "<i2"), budget))

    return answer(F.col(steps_col))
