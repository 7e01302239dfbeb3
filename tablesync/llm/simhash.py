"""SimHash near-duplicates: a similarity join of fingerprints with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, encoded, gathered, map_batches, partitions, record_batch, stored
from tablesync.llm.components import components

BITS, SEGMENTS = 64, 16
WIDTH = BITS // SEGMENTS
#: A bucket with more fingerprints is not compared pair by pair but through midpoints, see ``links``.
BUCKET = 4096
FLUSH = 1_000_000
LANES = np.uint64(0x0101010101010101)


def _majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For runs of hashes with these lengths (over 0): the bits that over half of each run have set."""
    starts = np.cumsum(lengths) - lengths
    pieces = -(-lengths // 255)  # a byte lane counts up to 255
    first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    piece_starts = np.repeat(starts, pieces) + 255 * within
    result = np.zeros(len(lengths), np.uint64)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & LANES, piece_starts)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for lane in range(8):
            result |= (2 * counts[:, lane] > lengths).astype(np.uint64) << np.uint64(8 * lane + j)
    return result


def fingerprints_of(texts: list[bytes], shingle_words: int) -> np.ndarray:
    """SimHash of UTF-8 texts over word shingles, A-Z lower-cased; 0 for a text without words."""
    result, hashes, lengths, places, held = np.zeros(len(texts), np.uint64), [], [], [], 0
    digest = xxhash.xxh64_intdigest

    def flush() -> None:
        if lengths:
            result[places] = _majority(np.concatenate(hashes), np.array(lengths, np.int64))
            hashes.clear(), lengths.clear(), places.clear()

    for k, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle_words:
            values = [digest(joined, 42)]
        else:
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes).tolist()
            values = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle_words - 1 :].tolist(), strict=False)]
        hashes.append(np.array(values, np.uint64))
        lengths.append(len(values))
        places.append(k)
        held += len(values)
        if held >= FLUSH:
            flush()
            held = 0
    flush()
    return result


def fingerprints_of_hashes(every_hash: list[np.ndarray]) -> np.ndarray:
    """As ``fingerprints_of``, for texts whose shingle hashes are known."""
    result, hashes, places, held = np.zeros(len(every_hash), np.uint64), [], [], 0

    def flush() -> None:
        if places:
            result[places] = _majority(np.concatenate(hashes), np.array(list(map(len, hashes)), np.int64))
            hashes.clear(), places.clear()

    for k, found in enumerate(every_hash):
        if len(found):
            hashes.append(found), places.append(k)
            held += len(found)
            if held >= FLUSH:
                flush()
                held = 0
    flush()
    return result


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp``, the 64 bits of the SimHash as a long. A null text has no words."""

    def run(columns: dict) -> dict:
        return {"id": columns["id"], "fp": fingerprints_of(encoded(columns["text"]), shingle_words).view(np.int64)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "id long, fp long")


def chain_patterns(length: int, max_bits: int) -> list[tuple[int, ...]]:
    """Which segments of a chain may differ: the largest sets with at most ``l * max_bits / SEGMENTS`` of the first ``l``."""
    budget = [l * max_bits // SEGMENTS for l in range(length + 1)]
    found = [
        free
        for free in combinations(range(1, length + 1), budget[length])
        if all(sum(p <= l for p in free) <= budget[l] for l in range(1, length + 1))
    ]
    return found


def chain_length(count: int, max_bits: int) -> int:
    """The shortest chain whose key has at least as many bits as it takes to tell ``count`` fingerprints apart."""
    needed = max(count, 1).bit_length() - 1
    ends = [l for l in range(1, SEGMENTS) if (l + 1) * max_bits // SEGMENTS > l * max_bits // SEGMENTS]
    for l in ends:
        if WIDTH * (l - l * max_bits // SEGMENTS) >= needed:
            return l
    return ends[-1]


def _keys(fps: np.ndarray, length: int, max_bits: int) -> tuple[np.ndarray, int]:
    """For every fingerprint a key per chain start and pattern; the low bits hold which of these it is."""
    patterns, keys = chain_patterns(length, max_bits), []
    slots = SEGMENTS * len(patterns)
    low = np.uint64((1 << max(1, (slots - 1).bit_length())) - 1)
    for start in range(SEGMENTS):
        turned = _turn(fps, start)
        for k, free in enumerate(patterns):
            mask = sum(((1 << WIDTH) - 1) << (BITS - WIDTH * p) for p in range(1, length + 1) if p not in free)
            if mask & int(low):
                raise ValueError("chain too long for its key")
            keys.append((turned & np.uint64(mask)) | np.uint64(start * len(patterns) + k))
    return np.stack(keys, axis=1), len(patterns)


def _turn(values: np.ndarray, start) -> np.ndarray:
    """Rotate to the left so that the chain's first segment is on top."""
    by = np.asarray(start * WIDTH, np.uint64)
    return (values << by) | np.where(by == 0, np.uint64(0), values >> ((np.uint64(BITS) - by) & np.uint64(63)))


def _chained(differing: np.ndarray, start, max_bits: int) -> np.ndarray:
    """Pigeonring: every prefix of the chain of all segments from ``start`` keeps within its share of the bits.

    If at most ``max_bits`` bits differ in all, some start has that property. The last prefix is the whole fingerprint,
    so the test prunes by short prefixes first and ends with the full distance.
    """
    turned = _turn(differing, start)
    fits = np.ones(len(turned), bool)
    for l in range(1, SEGMENTS + 1):
        share = l * max_bits // SEGMENTS
        if l == SEGMENTS or (l + 1) * max_bits // SEGMENTS > share:
            at = np.flatnonzero(fits)
            mask = np.uint64(((1 << BITS) - 1) ^ ((1 << (BITS - WIDTH * l)) - 1))
            fits[at] = np.bitwise_count(turned[at] & mask) <= share
    return fits


def _forest(members: np.ndarray, start: int, max_bits: int) -> tuple[list[int], list[int]]:
    """Edges that connect what the links among the members of a bucket connect, fewer than members."""
    left, a, b = members.copy(), [], []
    queue: list[np.uint64] = []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
            continue
        node = queue.pop()
        hit = _chained(left ^ node, np.uint64(start), max_bits)
        found, left = left[hit], left[~hit]
        a += [int(node)] * len(found)
        b += found.tolist()
        queue += list(found)
    return a, b


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints that connect what all pairs within ``max_bits`` connect.

    A fingerprint is a ring of 16 segments. A linked pair has a start from which each chain of ``l``
    segments differs in at most ``l * max_bits / 16`` bits. So the pair agrees in all but a few of the first segments
    of that chain: those are the keys, one per start and choice of the segments left out, of a length that
    grows with the number of fingerprints. Within a bucket, the chain test and the full distance decide, and a spanning
    forest stands for its pairs.

    A bucket of over BUCKET fingerprints is handled through midpoints: two fingerprints within ``max_bits``
    (even) have a value within half of it of both, and each such value is shared by a bounded number of fingerprints. So tying
    those of a value together finds the same connections in one shuffle, without pairs.
    """
    if max_bits % 2 or not 0 < max_bits < SEGMENTS:
        raise ValueError("max_bits is even, from 2 to 14")
    spark = fps.sparkSession
    count = fps.count()
    length = chain_length(count, max_bits)

    def spread(columns: dict) -> dict:
        values = columns["fp"].to_numpy().view(np.uint64)
        keys, _ = _keys(values, length, max_bits)
        return {"key": keys.ravel().view(np.int64), "fp": np.repeat(values, keys.shape[1]).view(np.int64)}

    n_patterns = len(chain_patterns(length, max_bits))
    low = np.uint64((1 << max(1, (SEGMENTS * n_patterns - 1).bit_length())) - 1)
    target = arrow_schema(spark, "a long, b long, crowded boolean")

    def solve(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch | None:
        """Whole buckets, sorted by key."""
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[first, len(keys)])
        starts = ((keys[first] & low) // np.uint64(n_patterns)).astype(np.uint64)
        two = first[sizes == 2]
        near = _chained(values[two] ^ values[two + 1], starts[sizes == 2], max_bits) if len(two) else np.zeros(0, bool)
        a, b = [values[two][near]], [values[two + 1][near]]
        crowded = np.zeros(0, np.uint64)
        for k in np.flatnonzero(sizes > 2):
            members = values[first[k] : first[k] + sizes[k]]
            if sizes[k] > BUCKET:
                crowded = np.concatenate([crowded, members])
                continue
            x, y = _forest(members, int(starts[k]), max_bits)
            a.append(np.array(x, np.uint64)), b.append(np.array(y, np.uint64))
        left, right = np.concatenate([*a, crowded]), np.concatenate([*b, crowded])
        if not len(left):
            return None
        flags = np.arange(len(left)) >= len(left) - len(crowded)
        return record_batch({"a": left.view(np.int64), "b": right.view(np.int64), "crowded": flags}, target)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets from rows sorted by key; a crowded one is passed on as it comes, never held."""
        none = np.zeros(0, np.uint64)
        keys, values, passing = none, none, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy().view(np.uint64)])
            values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
            if passing is not None:
                same = int((keys == passing).sum())
                if same:
                    flags = np.ones(same, bool)
                    yield record_batch({"a": values[:same].view(np.int64), "b": values[:same].view(np.int64), "crowded": flags}, target)
                keys, values = keys[same:], values[same:]
                if len(keys):
                    passing = None
                else:
                    continue
            tail = int((keys == keys[-1]).sum())
            whole = len(keys) - tail
            if whole and (out := solve(keys[:whole], values[:whole])) is not None:
                yield out
            keys, values = keys[whole:], values[whole:]
            if tail > BUCKET:
                passing = keys[0]
                yield record_batch({"a": values.view(np.int64), "b": values.view(np.int64), "crowded": np.ones(tail, bool)}, target)
                keys, values = none, none
        if len(keys) and (out := solve(keys, values)) is not None:
            yield out

    rows = map_batches(fps.select("fp"), spread, "key long, fp long")
    sorted_rows = rows.repartition(partitions(spark), "key").sortWithinPartitions("key")
    found = sorted_rows.mapInArrow(buckets, "a long, b long, crowded boolean").distinct()
    found = stored(gathered(found, count * SEGMENTS * n_patterns), "simhash-links")  # a bucket has fewer links than fingerprints
    direct = found.where("NOT crowded").select("a", "b")
    crowd = found.where("crowded").select(F.col("a").alias("fp")).distinct()
    if crowd.isEmpty():
        return direct
    return direct.union(_through_midpoints(crowd, max_bits // 2))


def _through_midpoints(fps: DataFrame, radius: int) -> DataFrame:
    masks = np.array([sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)], np.uint64)

    target = arrow_schema(fps.sparkSession, "middle long, fp long")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(every), 128):  # each becomes as many rows as there are masks
                values = every[first : first + 128]
                middle = (values[:, None] ^ masks[None, :]).ravel()
                yield record_batch({"middle": middle.view(np.int64), "fp": np.repeat(values, len(masks)).view(np.int64)}, target)

    pieces = fps.repartition(4 * partitions(fps.sparkSession)).mapInArrow(spread, "middle long, fp long")
    least = pieces.groupBy("middle").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("middle", "a")
    return pieces.join(least, "middle").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, max_bits: int = 4, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group all documents whose SimHash fingerprints are linked, directly or through others.

    Words are split at ASCII white space and lower-cased in A-Z; a shingle's hash is XXH64 with seed 42;
    fingerprints link at ``max_bits`` or fewer differing bits. Equal fingerprints are joined once per
    distinct value, so copies never become pairs.

    Returns ``id_col``, fingerprint (16 hexadecimal digits) and component_id, the smallest id of the component. Defined cases: a null
    or empty text has fingerprint zero and is linked like any other; with fewer words than a shingle the whole text is one;
    repeated rows give a row each; null ids are grouped but never name a component that has another id;
    an empty table gives no rows; other columns are not looked at.
    """
    marked = stored(fingerprints(docs, shingle_words, id_col, text_col), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = stored(components(links(classes.select("fp"), max_bits)), "simhash-roots")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(of_class, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, max_bits: int = 4, shingle_words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The input rows without near-duplicates: of each group the document with the smallest id stays, of equal rows one.

    A null id is greater than all others. All columns stay as they are.
    """
    digest = lambda: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), digest().alias("digest"))

    def marks(columns: dict) -> dict:
        fps = fingerprints_of(encoded(columns["text"]), shingle_words).view(np.int64)
        return {"id": columns["id"], "digest": columns["digest"], "fp": fps}

    marked = stored(map_batches(keyed, marks, "id long, digest long, fp long"), "simhash")
    roots = _rooted(marked.select("fp").distinct(), max_bits)
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "digest")
    keepers = marked.join(roots, "fp").groupBy("root").agg(F.min(order).alias("least")).select("least.id", "least.digest")
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), digest().alias("digest"))
    known = F.coalesce(F.col("id"), F.lit((1 << 63) - 1))
    keepers = keepers.select(known.alias("key"), "digest")
    kept = whole.withColumn("key", known).join(keepers, ["key", "digest"], "left_semi").dropDuplicates(["key", "digest"])
    return kept.select("row.*")


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp`` and ``root`` of its component, for distinct fingerprints."""
    fps = stored(fps, "simhash-classes")
    roots = stored(components(links(fps, max_bits)), "simhash-roots")
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
