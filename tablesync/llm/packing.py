"""Packing documents into sequences: exact complements by length, then best fit."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import byte_characters, encoded, map_batches, partitions, running_total, stored

Pattern = tuple[int, ...]


# Fixed value: how the tokenizer splits lower-case text without white space.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Visible characters that are composed already and whose lower case is in the same range.
PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u00ff]+")
#: A text of these and of white space only, as Latin-1, and how PIECE splits it: there the classes are few characters.
PLAIN_BYTES = bytes(b for b in range(256) if PLAIN.fullmatch(chr(b))) + b" \t\n\x0b\x0c\r"


def _latin(kind: str) -> str:
    return "".join(re.escape(chr(b)) for b in range(256) if unicodedata.category(chr(b))[0] == kind)


PLAIN_PIECE = re.compile(f"[{_latin('L')}]+|[{_latin('N')}]|'(?:[stmd]|re|ve|ll)|[^\\s{_latin('L')}{_latin('N')}]+")


class PieceIds(dict):
    """What a function gives for pieces; those not used for long go first, results do not change."""

    def __init__(self, function: Callable[[str], bytes], limit: int):
        super().__init__()
        self.function, self.limit = function, limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = self.function(piece)
        self[piece] = found
        return found


class WordIds(dict):
    """The ids of words as little-endian bytes, by a word-end BPE that lower-cases and drops white space.

    Such a tokenizer never looks across white space, so a text's ids are those of its words in turn. The pieces of a plain word
    go to the BPE model itself, once per distinct piece; any other word goes through the whole tokenizer. A plain text is
    split into its pieces at once, and its words, of which far more are distinct, are not looked at.
    """

    #: Distinct words and pieces kept per Python worker, twice; older ones go first, results do not change.
    LIMIT = 180_000

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.pieces = PieceIds(self._piece, self.LIMIT)
        self.shown = {b: c for c, b in byte_characters().items()}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            text = word.decode()
            if text.isascii() and text.isalpha():
                found = self.pieces[text.lower()]
            elif PLAIN.fullmatch(text) and "<|" not in text:
                found = b"".join(map(self.pieces.__getitem__, PIECE.findall(text.lower())))
            else:
                found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = found
        return found

    def of_text(self, text: bytes) -> bytes:
        """The ids of a text, given and returned as bytes."""
        shown = text.decode()
        try:
            plain = not shown.encode("latin-1").translate(None, PLAIN_BYTES) and "<|" not in shown
        except UnicodeEncodeError:
            plain = False
        if plain:
            return b"".join(map(self.pieces.__getitem__, PLAIN_PIECE.findall(shown.lower())))
        return b"".join(map(self.__getitem__, text.split()))

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, length: int, end_id: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Tokenize, end every document with ``end_id`` and cut only those that are longer than a sequence."""
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(columns: dict) -> dict:
        known, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        out: dict[str, list] = {name.split()[0]: [] for name in schema.split(", ")}
        for doc, text in zip(columns["id"].to_pylist(), encoded(columns["text"]), strict=True):
            data = known.of_text(text) + end
            for piece, at in enumerate(range(0, len(data), 4 * length)):
                part = data[at : at + 4 * length]
                out["id"].append(doc)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if with_ids:
                    out["ids"].append(part)
        return out

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, cut, schema)


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of lengths with the number of sequences of each, for so many pieces of each length.

    From the longest length on, its gap is filled exactly: by one piece of that length, by a pair or by a
    triple with that sum, as often as all its lengths are still there. What has no exact complement goes, longest first,
    into the fullest sequence that has room.
    """
    there = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        there[size] += n
    plan: list[tuple[Pattern, int]] = []

    def take(pattern: Pattern) -> None:
        times = min(int(there[size]) // pattern.count(size) for size in set(pattern))
        for size in pattern:
            there[size] -= times
        plan.append((pattern, times))

    if there[capacity]:
        take((capacity,))
    for size in range(capacity - 1, 0, -1):
        while there[size]:
            found = _complement(there, size, capacity - size)
            if found is None:
                break
            take((size, *found))
    return plan + _best_fit(there, capacity)


def _pair(there: np.ndarray, total: int) -> Pattern | None:
    """Two lengths with this sum that are both there, the largest of them as large as can be."""
    small = np.arange(1, total // 2 + 1)
    ok = (there[small] > 0) & (there[total - small] > 0)
    if total % 2 == 0 and len(ok) and there[total // 2] < 2:
        ok[-1] = False
    found = int(ok.argmax()) if len(ok) else 0
    return (total - int(small[found]), int(small[found])) if len(ok) and ok[found] else None


def _pair_sums(there: np.ndarray) -> np.ndarray:
    """The sums that two available lengths have, as an index by sum (a convolution of what is there with itself)."""
    size = 2 * len(there)
    spectrum = np.fft.rfft((there > 0).astype(float), size)
    return np.fft.irfft(spectrum * spectrum, size)[: len(there)] > 0.5


def _complement(there: np.ndarray, size: int, gap: int) -> Pattern | None:
    there[size] -= 1  # the piece whose gap is filled
    try:
        if there[gap] > 0:
            return (gap,)
        pair = _pair(there, gap)
        if pair is not None:
            return pair
        thirds = np.arange(1, gap)
        for third in thirds[(there[1:gap] > 0) & _pair_sums(there)[gap - thirds]][::-1].tolist():
            there[third] -= 1
            pair = _pair(there, gap - third)
            there[third] += 1
            if pair is not None:
                return (third, *pair)
        return None
    finally:
        there[size] += 1


def _best_fit(there: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    open_bins: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    filled = np.zeros(capacity + 1, np.int64)  # sequences by gap

    def put(pattern: Pattern, n: int) -> None:
        gap = capacity - sum(pattern)
        open_bins[gap].append((pattern, n))
        filled[gap] += n

    for size in range(capacity, 0, -1):
        left = int(there[size])
        while left:
            room = np.flatnonzero(filled[size:])
            if len(room):
                gap = int(room[0]) + size
                pattern, n = open_bins[gap].pop()
                filled[gap] -= n
            else:
                pattern, n, gap = (), -(-left // (capacity // size)), capacity
            each = min(left, gap // size)
            used = min(n, left // each)
            put(pattern + (size,) * each, used)
            if pattern and n > used:
                put(pattern, n - used)
            left -= used * each
    return [entry for gap in sorted(open_bins) for entry in open_bins[gap]]


def _places(plan: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For every run of pieces of one length: its first rank, sequence and offset, sorted for lookup."""
    rank: dict[int, int] = defaultdict(int)
    runs, sequence = [], 0
    for pattern, n in plan:
        offset = 0
        for size in pattern:
            runs.append((size, rank[size], sequence, offset))
            rank[size] += n
            offset += size
        sequence += n
    table = np.array(sorted(runs) or [(0, 0, 0, 0)], np.int64)
    return {"key": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``length`` tokens as exact complements and best fit give.

    Only the number of pieces of every length decides the plan. That is at most ``length`` numbers, so the plan is made on the
    driver; pieces of one length are then numbered (counted by length and hash part, then
    within a part) and look their place up in it. The tokenizer has to drop white space.

    Returns ``id_col``, piece, start, length, ids_crc32, sequence_id, offset and, with ``with_ids``, the ids themselves.
    Defined cases: a null or empty text is just the end id; repeated rows and null ids are packed like
    any other; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer, length, end_id, id_col, text_col, with_ids), "packing")
    spread = partitions(spark)
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(spread)))
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-counts")
    lengths = {size: n for size, n in counts.groupBy("length").agg(F.sum("n")).collect()}
    places = _places(packing_plan(lengths, length))
    starts = running_total(counts, ["length"], "part", "n", "before").select("length", "part", "before")
    order = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order)).join(starts, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rank") - 1).drop("before", "part")
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    types = dict(pieces.dtypes)
    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", sequence_id long, offset long"

    def place(columns: dict) -> dict:
        size, rank = (columns[n].to_numpy() for n in ("length", "rank"))
        at = np.searchsorted(places["key"], (size << 44) + rank, side="right") - 1
        return {n: columns[n] for n in names} | {
            "sequence_id": places["sequence"][at] + rank - places["rank"][at],
            "offset": places["offset"][at],
        }

    return map_batches(ranked.select(*names, "rank"), place, schema).withColumnRenamed("id", id_col)
