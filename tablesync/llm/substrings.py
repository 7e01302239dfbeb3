"""Exact substring dedup on word windows by super-k-mer partitioning."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import SPACES, arrow_schema, encoded, map_batches, mixed, partitions, record_batch, stored, text_or_empty

MER = 3  # words per minimiser candidate
PARTS_PER_TASK, CELLS_PER_PART, LEAST_CELLS = 8, 2, 4096
#: A cell with fewer windows is never worth another route.
SMALL_CELL = 20_000
#: Texts are hashed together up to CHUNK bytes and packed together up to PACKED bytes.
CHUNK, PACKED = 1 << 19, 1 << 23
PACKED_ROWS = 2500
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
STEP = 0x9E3779B97F4A7C15
PACK = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("more", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("text", pa.binary())])
_WHITE = np.isin(np.arange(256), list(SPACES))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    back = np.uint64(pow(STEP, -1, 1 << 64))
    size = 1 << 16
    return np.cumprod(np.r_[np.uint64(1), np.full(size, np.uint64(STEP))]), np.cumprod(np.r_[np.uint64(1), np.full(size, back)])


def _run_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of runs of values, the same wherever a run lies; runs are ascending and of any length."""
    with np.errstate(over="ignore"):
        forward, back = _powers()
        size = len(forward) - 1
        n = len(values)
        tiles = -(-n // size) if n else 0
        # Powers by block and within it, so that the tables stay small.
        jump, unjump = np.uint64(pow(STEP, size, 1 << 64)), np.uint64(pow(pow(STEP, -1, 1 << 64), size, 1 << 64))
        block, unblock = np.cumprod(np.r_[np.uint64(1), np.full(tiles, jump)]), np.cumprod(np.r_[np.uint64(1), np.full(tiles, unjump)])
        weights = (forward[None, :size] * block[:tiles, None]).ravel()[:n]
        sums = np.r_[np.uint64(0), np.cumsum(values * weights)]
        return mixed((sums[ends] - sums[begins]) * (back[begins % size] * unblock[begins // size]))


@dataclass
class Words:
    """The words of some texts: where they lie in ``data``, of which text they are, and their hashes."""

    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        """White space becomes one space."""
        data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        white = _WHITE[data]
        keep = np.r_[True, ~(white[1:] & white[:-1])]
        places = np.cumsum(np.r_[0, np.fromiter(map(len, texts), np.int64, len(texts)) + 1])  # the break before each text
        data = np.where(white, np.uint8(32), data)[keep]
        white = white[keep]
        begins = np.flatnonzero(white[:-1] & ~white[1:]) + 1
        ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
        original = np.flatnonzero(keep)[begins]
        text = np.searchsorted(places, original, side="right") - 1
        return cls(data, begins, ends, text, _run_hashes(data.astype(np.uint64) + np.uint64(1), begins, ends))


def _chunks(texts: list[bytes], limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts with the number of the first."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield first, texts[first : k + 1]
            first, held = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of MER consecutive words in every window; frequent words alone never decide."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        count = len(hashes) - MER + 1
        mers = hashes[:count]
        for k in range(1, MER):
            mers = mixed(mers + np.uint64(STEP) * hashes[k : k + count])
    need, width = window - MER + 1, 1
    while 2 * width <= need:
        mers = np.minimum(mers[:-width], mers[width:])
        width *= 2
    return np.minimum(mers[: len(mers) - (need - width)], mers[need - width :]) if need > width else mers


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of all windows within one text, and their minimisers."""
    smallest = minimisers(words.hashes, window)
    at = np.flatnonzero(words.text[: len(smallest)] == words.text[window - 1 :]) if len(smallest) else np.zeros(0, np.int64)
    return at, smallest[at]


def _cells(smallest: np.ndarray, cells: int) -> np.ndarray:
    """Cells of minimisers, mixed once more: as smallest hashes they crowd at the low end."""
    return ((mixed(smallest) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)


def covered_windows(ids: np.ndarray, counts: np.ndarray, texts: list[bytes], window: int) -> np.ndarray:
    """For all windows of some packed strings, in order: does the same word sequence occur with a smaller id?

    ``counts`` are the words of each string. Windows are sorted by hash, and those of one hash are compared as text.
    """
    keys, begins, ends, joined, base = [], [], [], [], 0
    for first, some in _chunks(texts, CHUNK):
        words = Words.of(some)
        n = counts[first : first + len(some)]
        windows = n - window + 1
        at = np.repeat(np.cumsum(n) - n - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
        keys.append(_window_hashes(words.hashes, at, window))
        begins.append(words.begins[at] + base), ends.append(words.ends[at + window - 1] + base)
        joined.append(words.data.tobytes())
        base += len(words.data)
    keys, begins, ends, data = np.concatenate(keys), np.concatenate(begins), np.concatenate(ends), b"".join(joined)
    del joined
    owner = np.repeat(ids, counts - window + 1)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    result = np.zeros(len(keys), bool)
    alone = new & np.r_[new[1:], True]
    shared = np.flatnonzero(~alone)
    if not len(shared):
        return result
    at = order[shared]
    starts = np.flatnonzero(new[shared])
    least = np.minimum.reduceat(owner[at], starts)
    result[at] = owner[at] > np.repeat(least, np.diff(np.r_[starts, len(at)]))
    differ = ~_as_before(data, begins[at], ends[at])
    differ[starts] = False
    for k in np.unique(np.searchsorted(starts, np.flatnonzero(differ), side="right") - 1).tolist():
        # Another text with the same hash: go by the texts themselves.
        own = at[starts[k] : starts[k + 1] if k + 1 < len(starts) else len(at)].tolist()
        smallest: dict[bytes, int] = {}
        for w in own:
            text = data[begins[w] : ends[w]]
            smallest[text] = min(smallest.get(text, owner[w]), owner[w])
        result[own] = [owner[w] > smallest[data[begins[w] : ends[w]]] for w in own]
    return result


def _as_before(data: bytes, begins: np.ndarray, ends: np.ndarray, block: int = 50_000) -> np.ndarray:
    """For slices of the data, whether each is equal to the one before it; few are held at a time."""
    same, last = np.zeros(len(begins), bool), b""
    for first in range(0, len(begins), block):
        places = zip(begins[first : first + block].tolist(), ends[first : first + block].tolist(), strict=True)
        for k, (a, b) in enumerate(places, first):
            text = data[a:b]
            same[k] = text == last
            last = text
    return same


def _window_hashes(hashes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    return _run_hashes(hashes, at, at + window)


def _spans(flags: np.ndarray, windows: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of covered windows as (string, first word, word after the last)."""
    string = np.repeat(np.arange(len(windows)), windows)
    place = np.repeat(starts - np.cumsum(windows) + windows, windows) + np.arange(len(flags))
    edge = np.r_[True, string[1:] != string[:-1]] if len(string) else np.zeros(0, bool)
    begin = flags & (edge | ~np.r_[False, flags[:-1]])
    end = flags & (np.r_[edge[1:], True] | ~np.r_[flags[1:], False])
    return string[begin], place[begin], place[end] + window


def repeated_spans(keyed: DataFrame, window: int) -> DataFrame:
    """Spans of words covered by a window that also starts in a text with a smaller id.

    ``keyed`` has id (long, not null), digest and more (long, together 128 bits that tell texts of one id apart) and text. Returns
    id, digest, more, span (first word in the upper, word after the last in the lower half).

    Consecutive windows with one minimiser travel as one string to the part of their minimiser, where a
    sort by window hash brings equal windows together. A minimiser with more windows than an average part holds (at most
    as many as there are parts) has its windows sent one by one instead, grouped by their text: an aggregate finds the
    smallest id and a join, which Spark can split, brings it back.
    """
    spark = keyed.sparkSession
    tasks = partitions(spark)
    parts = PARTS_PER_TASK * tasks
    per_part = max(CELLS_PER_PART, -(-LEAST_CELLS // parts))
    cells = per_part * parts
    hot = _hot_cells(keyed, window, cells, parts)
    schema = "id long, digest long, more long, span long"
    target = arrow_schema(spark, schema)

    def solve(table: pa.Table) -> pa.Table:
        packs = [pa.ipc.open_stream(pa.py_buffer(blob.as_py())).read_all() for blob in table.column("pack")]
        every = pa.concat_tables(packs).combine_chunks()
        ids, digests, more, starts, counts = (every.column(n).to_numpy().astype(np.int64) for n in ("id", "digest", "more", "start", "words"))
        flags = covered_windows(ids, counts, every.column("text").to_pylist(), window)
        string, begin, end = _spans(flags, counts - window + 1, starts, window)
        return pa.Table.from_batches([record_batch({"id": ids[string], "digest": digests[string], "more": more[string], "span": begin << 32 | end}, target)])

    packed = _packed(keyed, window, cells, per_part, hot)
    spans = packed.repartition(tasks, "part").groupBy("part").applyInArrow(solve, schema)
    if len(hot):
        spans = spans.union(_hot_spans(keyed, window, cells, hot))
    return spans


def _hot_cells(keyed: DataFrame, window: int, cells: int, parts: int) -> np.ndarray:
    def count(columns: dict) -> dict:
        found = np.zeros(cells, np.int64)
        for _, some in _chunks(encoded(columns["text"]), CHUNK):
            _, smallest = _windows(Words.of(some), window)
            found += np.bincount(_cells(smallest, cells), minlength=cells)
        at = np.flatnonzero(found)
        return {"cell": at, "n": found[at]}

    counts = map_batches(keyed.select("text"), count, "cell long, n long")
    sums = stored(counts.groupBy("cell").agg(F.sum("n").alias("n")), "substrings-cells")
    every = sums.agg(F.sum("n")).first()[0] or 0
    limit = max(SMALL_CELL, every // parts)
    return np.array(sorted(c for (c,) in sums.where(F.col("n") > limit).select("cell").collect()), np.int64)


def _packed(keyed: DataFrame, window: int, cells: int, per_part: int, hot: np.ndarray) -> DataFrame:
    """Super-k-mers; those of some texts that go to one part travel as one compressed pack."""
    schema = "part long, pack binary"
    target = arrow_schema(keyed.sparkSession, schema)

    def pieces(some: list[bytes], ids: np.ndarray, digests: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, pa.Table]:
        words = Words.of(some)
        at, smallest = _windows(words, window)
        new = np.r_[True, (np.diff(at) != 1) | (smallest[1:] != smallest[:-1])] if len(at) else np.zeros(0, bool)
        first, last = at[new], at[np.r_[new[1:], True]] + window - 1 if len(at) else at
        own = _cells(smallest[new], cells)
        if len(hot):
            cold = ~np.isin(own, hot)
            first, last, own = first[cold], last[cold], own[cold]
        data, text = words.data.tobytes(), words.text[first]
        begin = np.searchsorted(words.text, text)
        strings = [data[a:b] for a, b in zip(words.begins[first].tolist(), words.ends[last].tolist(), strict=True)]
        columns = [ids[text], digests[text], more[text], (first - begin).astype(np.int32), (last - first + 1).astype(np.int32)]
        return own // per_part, pa.table([*columns, pa.array(strings, pa.binary())], schema=PACK)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, PACKED_ROWS) for b in batches for k in range(0, b.num_rows, PACKED_ROWS)):
            ids, digests, more, texts = *(batch.column(c).to_numpy() for c in range(3)), encoded(batch.column(3))
            for start, group in _chunks(texts, PACKED):
                found = []
                for first, some in _chunks(group, CHUNK):
                    own = slice(start + first, start + first + len(some))
                    found.append(pieces(some, ids[own], digests[own], more[own]))
                part = np.concatenate([p for p, _ in found])
                if not len(part):
                    continue
                order = np.argsort(part, kind="stable")
                table, part = pa.concat_tables([t for _, t in found]).combine_chunks().take(order), part[order]
                edges = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
                packs = []
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, PACK, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as writer:
                        writer.write_table(table.slice(a, b - a))
                    packs.append(sink.getvalue().to_pybytes())
                yield record_batch({"part": part[edges[:-1]], "pack": packs}, target)

    return keyed.select("id", "digest", "more", "text").mapInArrow(pack, schema)


def _hot_spans(keyed: DataFrame, window: int, cells: int, hot: np.ndarray) -> DataFrame:
    """The same answer for windows of hot minimisers: grouped by their text, each window a row."""

    schema = "window binary, id long, digest long, more long, span long"
    target = arrow_schema(keyed.sparkSession, schema)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            ids, digests, more = (batch.column(c).to_numpy() for c in range(3))
            for start, some in _chunks(encoded(batch.column(3)), CHUNK):
                words = Words.of(some)
                at, smallest = _windows(words, window)
                at = at[np.isin(_cells(smallest, cells), hot)]
                data, text = words.data.tobytes(), words.text[at]
                place = at - np.searchsorted(words.text, text)
                found = [data[a:b] for a, b in zip(words.begins[at].tolist(), words.ends[at + window - 1].tolist(), strict=True)]
                own = {"id": ids[start + text], "digest": digests[start + text], "more": more[start + text], "span": place << 32 | place + window}
                yield record_batch({"window": found} | own, target)

    rows = stored(keyed.select("id", "digest", "more", "text").mapInArrow(single, schema), "substrings-hot")
    first = rows.groupBy("window").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("most > least")
    return rows.join(first.select("window", "least"), "window").where("id > least").select("id", "digest", "more", "span")


def _cut(text: bytes, spans: np.ndarray) -> tuple[int, int, bytes, bytes | None]:
    """Words, removed words, the kept words joined by one space, and the text without the removed words."""
    words = text.split()
    if not len(spans):
        return len(words), 0, b" ".join(words), None
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, spans >> 32, 1)
    np.add.at(steps, spans & 0xFFFFFFFF, -1)
    keep = np.cumsum(steps)[:-1] == 0
    kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    places = [m.span() for m in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.r_[False, keep, False]))
    pieces = [text[places[a][0] : places[b - 1][1]] for a, b in edges.reshape(-1, 2).tolist()]
    return len(words), len(words) - len(kept), b" ".join(kept), b"\n".join(pieces)


def dedup_substrings(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = False
) -> DataFrame:
    """Remove every word that is covered by a window of words that also starts in a document with a smaller id.

    Windows are ``window`` consecutive words of one document, compared as they are, and all judged on the
    input. Returns ``id_col``, n_words, n_removed and kept_sha256 (of the kept words, joined by one space); with ``with_rows`` also
    ``row`` (the other input columns) and ``kept_text`` (the text, where words are removed with those cut out, white space kept
    elsewhere and a line break where a cut was).

    Defined cases: a null or short text has no window and loses nothing; documents with one id do not remove each other's
    words; a null id counts as greater than all others; repeated rows lose the same words; an empty
    table gives no rows; other columns are not looked at.
    """
    text = text_or_empty(text_col)
    last = F.lit((1 << 63) - 1)
    # Texts of one id are told apart by 64 bits, those without an id, which may be very many, by 128.
    more = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(1), text)).otherwise(F.lit(0).cast("long"))
    digests = [F.xxhash64(text).alias("digest"), more.alias("more")]
    columns = [F.coalesce(F.col(id_col).cast("long"), last).alias("id"), *digests, text.alias("text")]
    keyed = docs.select(*columns)
    lists = repeated_spans(keyed, window).groupBy("id", "digest", "more").agg(F.collect_set("span").alias("spans"))
    others = [F.col(c) for c in docs.columns if c != text_col]
    row = [F.struct(*others).alias("row")] if with_rows else []
    columns[3] = F.col(text_col).cast("string").alias("text")
    whole = docs.select(*columns, F.col(id_col).cast("long").alias("own_id"), *row)
    row_type = f", row {whole.schema['row'].dataType.simpleString()}" if with_rows else ""

    def squeeze(columns: dict) -> dict:
        compress = zstandard.ZstdCompressor(level=3).compress
        return columns | {"text": [None if t is None else compress(t) for t in columns["text"].cast(pa.binary()).to_pylist()]}

    # Texts travel compressed one by one, to two thirds of what Spark's blocks would come to.
    small = map_batches(whole, squeeze, f"id long, digest long, more long, text binary, own_id long{row_type}")
    rows = small.join(lists, ["id", "digest", "more"], "left")
    schema = "own_id long, n_words long, n_removed long, kept_sha256 string" + (f"{row_type}, kept_text string" if with_rows else "")

    def finish(columns: dict) -> dict:
        out: dict = {"own_id": columns["own_id"], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        expand = zstandard.ZstdDecompressor().decompress
        for text, spans in zip(columns["text"], columns["spans"], strict=True):
            data = expand(text.as_py()) if text.is_valid else b""
            n, removed, kept, rest = _cut(data, np.array(spans.as_py() or (), np.int64))
            out["n_words"].append(n), out["n_removed"].append(removed)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_rows:
                whole_text = data.decode() if text.is_valid else None
                out["kept_text"].append(whole_text if rest is None else rest.decode())
        if with_rows:
            out["row"] = columns["row"]
        return out

    return map_batches(rows, finish, schema).withColumnRenamed("own_id", id_col)


def without_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The input rows with repeated words cut out of the text and ``chars_col``, where it is there, brought up to date.

    A document that loses all its words goes; one that loses none stays as it is.
    """
    cut = dedup_substrings(docs, window, id_col, text_col, with_rows=True).where("n_removed = 0 OR n_removed < n_words")
    columns = []
    for name, kind in docs.dtypes:
        if name == text_col:
            column = F.col("kept_text").cast(kind)
        elif name == chars_col:
            column = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(F.col("row")[name])
        else:
            column = F.col("row")[name]
        columns.append(column.alias(name))
    return cut.select(*columns)
