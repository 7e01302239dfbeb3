"""Document fingerprints from improbable features, in chained Bloom filters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, encoded, map_batches, mixed, partitions, record_batch, stored

#: A feature is a window of so many bytes; the rarest in each run of SPAN windows is voted for, and chosen from VOTES on.
WINDOW, SPAN, VOTES = 32, 32, 8
LEVELS = 1024
FILTER_BITS, FEATURE_BITS, PER_FILTER = 2048, 5, 128
#: Whole texts are handled together up to so many bytes.
CHUNK = 1 << 18
#: c * log2(c) in integers, so that running sums are exact.
_WEIGHT = np.round(np.arange(WINDOW + 2) * np.log2(np.maximum(np.arange(WINDOW + 2), 1)) * 4096).astype(np.int64)
_GAIN = np.diff(_WEIGHT)  # by the count before one more
_MOST = int(_WEIGHT[WINDOW])


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """The entropy of every window of WINDOW bytes, as a level from 0 to LEVELS - 1."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        equal = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += equal
        after[:-d] += equal
    first = int(_WEIGHT[np.bincount(data[:WINDOW])].sum())
    # Sliding on by one byte: the new byte meets its equals in the window, the old one leaves its equals.
    change = _GAIN[before[WINDOW:]] - _GAIN[after[: n - WINDOW]]
    sums = first + np.r_[0, np.cumsum(change)]
    return (_MOST - sums) * (LEVELS - 1) // _MOST


def level_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(LEVELS, np.int64)
    for group in _chunks(texts):
        data, ends, inside = _joined(group)
        levels = entropy_levels(data)
        counts += np.bincount(levels[inside[: len(levels)]], minlength=LEVELS)
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of every entropy level, the rarest first; windows of almost no entropy are never features."""
    order = np.lexsort((np.arange(LEVELS), counts))
    ranks = np.empty(LEVELS, np.int64)
    ranks[order] = np.arange(LEVELS)
    ranks[: LEVELS // 10] = LEVELS
    return ranks


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, where each text ends, and which windows lie within one text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    inside = np.ones(len(data), bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - WINDOW + 1) : end] = False
    return data, ends, inside[: max(0, len(data) - WINDOW + 1)]


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """For each text its chain of filters, as an array (filters, FILTER_BITS / 64) of 64-bit words."""
    result: list[np.ndarray] = []
    for group in _chunks(texts):
        data, ends, inside = _joined(group)
        places, keys = _features(data, ends, inside, ranks)
        owner = np.searchsorted(ends, places, side="right")
        edges = np.searchsorted(owner, np.arange(len(group) + 1))
        for k, text in enumerate(group):
            own = keys[edges[k] : edges[k + 1]]
            if text and not len(own):  # shorter than a window, or nothing stands out: the text is its own feature
                own = np.frombuffer(hashlib.sha1(text).digest()[:8], "<u8")
            result.append(_filters(own))
    return result


def _features(data: np.ndarray, ends: np.ndarray, inside: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows that are the rarest of their surroundings often enough."""
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # A run that begins in a text holds no window of the next one: the WINDOW - 1 between them belong to neither.
    rank = np.full(len(inside) + SPAN - 1, 2 * LEVELS)
    rank[: len(inside)] = np.where(inside, ranks[entropy_levels(data)], 2 * LEVELS)
    n = len(inside)
    least, width = rank << 32 | np.arange(len(rank)), 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    winner = least & 0xFFFFFFFF
    valid = (least >> 32 < LEVELS) & inside
    votes = np.bincount(winner[valid], minlength=n)
    places = np.flatnonzero(votes >= VOTES)
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places].reshape(-1, WINDOW)
    words = np.ascontiguousarray(windows).view("<u8")
    keys = np.zeros(len(places), np.uint64)
    for k in range(WINDOW // 8):
        keys = mixed(keys ^ words[:, k])
    return places, keys


def _filters(keys: np.ndarray) -> np.ndarray:
    """Insert features in order; a full filter is followed by a new one."""
    chain = np.zeros((max(1, -(-len(keys) // PER_FILTER)), FILTER_BITS // 64), np.uint64)
    which = np.arange(len(keys)) // PER_FILTER
    for k in range(FEATURE_BITS):
        bit = (keys >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)
        np.bitwise_or.at(chain, (which, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return chain


def _covered(small: np.ndarray, large: np.ndarray) -> float:
    """How well the filters of one chain are found in another: for each the best overlap, from chance (0) to all bits (1)."""
    ones, others = np.bitwise_count(small).sum(axis=1).astype(float), np.bitwise_count(large).sum(axis=1).astype(float)
    total, weight = 0.0, 0.0
    for row, n in zip(small, ones, strict=True):
        overlap = np.bitwise_count(large & row).sum(axis=1)
        chance, most = n * others / FILTER_BITS, np.minimum(n, others)
        share = np.where(most > chance, (overlap - chance) / np.maximum(most - chance, 1e-9), 0.0)
        total += n * float(np.clip(share, 0, 1).max())
        weight += n
    return total / weight if weight else 0.0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1: 1 for equal ones, the mean of both directions for chains of one length."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not a.any() or not b.any():
        return 0.0
    if len(a) != len(b):
        return _covered(*sorted((a, b), key=len))
    return (_covered(a, b) + _covered(b, a)) / 2


def as_text(chain: np.ndarray) -> str:
    return ":".join(row.astype("<u8").tobytes().hex() for row in chain)


def rarity_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks of entropy levels by how often they occur in all windows of all texts: LEVELS numbers."""

    def run(columns: dict) -> dict:
        counts = level_counts(encoded(columns["text"]))
        at = np.flatnonzero(counts)
        return {"level": at, "n": counts[at]}

    sums = map_batches(docs.select(F.col(text_col).alias("text")), run, "level long, n long").groupBy("level").agg(F.sum("n"))
    counts = np.zeros(LEVELS, np.int64)
    for level, n in sums.collect():
        counts[level] = n
    return rarity(counts)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many code points of the start of another."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A digest of every whole text, and how like it is to the digests of its edited text and of the next document.

    Byte windows are ranked by how rare their entropy is among all windows of the corpus. The rarest of every run of
    windows gets a vote, windows with VOTES votes are features, and they fill a chain of
    Bloom filters. Likeness is the overlap of filter bits beyond chance, each filter with its best partner.

    Documents are put in order of their id over ranges of ids; each range also gets the first document of the
    next range, so that every document meets its successor (the last the first). Each text is shuffled once.

    Returns ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. Defined cases: a null text counts as
    empty, with an empty chain that is like (1) only another empty one; a text shorter than a window is one feature; null
    ids come first and equal ids are ordered by text; one row is its own successor; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    ranks = rarity_table(docs, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tasks = partitions(spark)
    cuts = rows.select("id").where("id IS NOT NULL").approxQuantile("id", [k / tasks for k in range(1, tasks)], 0.25 / tasks) if tasks > 1 else []
    cuts = np.array(sorted({int(c) for c in cuts}), np.int64)

    @F.pandas_udf("int")
    def range_of(ids):
        return ids.__class__(np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0).astype("int64"))), index=ids.index)

    parted = rows.withColumn("part", range_of("id"))
    # The first row of a range in (id, text) order goes to the range before, too: one row per range, at most one range per task.
    digest = F.sha2("text", 256)
    order = F.struct(F.col("id").isNotNull().alias("known"), F.col("id").alias("first_id"), digest.alias("first_digest"))
    firsts = stored(parted.groupBy("part").agg(F.min(order).alias("first")).select("part", "first.*"), "improbable")
    ranges = Window.orderBy("part")
    every_range = Window.partitionBy()
    firsts = firsts.select("*", F.coalesce(F.lag("part").over(ranges), F.max("part").over(every_range)).alias("before"))
    heads = (
        parted.join(F.broadcast(firsts), "part")
        .where(F.col("id").eqNullSafe(F.col("first_id")) & (digest == F.col("first_digest")))
        .dropDuplicates(["part"])
        .select("id", "text", F.col("before").alias("part"))
    )
    every = parted.withColumn("extra", F.lit(False)).unionByName(heads.withColumn("extra", F.lit(True)))
    placed = every.repartition(tasks, "part").sortWithinPartitions("part", "extra", F.col("id").isNotNull(), "id", digest)
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    target = arrow_schema(spark, schema)

    def described(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last document, which only follows."""
        plain = digests([t.encode() for t in texts], ranks)
        changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:], strict=False)]
        new = digests(changed, ranks)
        return record_batch(
            {
                "id": ids[:-1],
                "n_chars": [len(t) for t in texts[:-1]],
                "edited_sha256": [hashlib.sha256(t).hexdigest() for t in changed],
                "fingerprint": [as_text(c) for c in plain[:-1]],
                "edited_fingerprint": [as_text(c) for c in new],
                "near_edited": [likeness(a, b) for a, b in zip(plain, new, strict=False)],
                "near_next": [likeness(a, b) for a, b in zip(plain, plain[1:], strict=False)],
            },
            target,
        )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of each range in order, its successor last; a block ends at the range's end or at CHUNK characters."""
        ids, texts, held, now = [], [], 0, None
        for batch in batches:
            for i, text, part, extra in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if part != now:
                    ids, texts, held, now = [], [], 0, part
                ids.append(i), texts.append(text)
                held += len(text)
                if extra or held >= CHUNK:
                    if len(ids) > 1:
                        yield described(ids, texts)
                    ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])

    return placed.select("id", "text", "part", "extra").mapInArrow(describe, schema).withColumnRenamed("id", id_col)
