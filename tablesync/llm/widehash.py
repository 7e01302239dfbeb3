"""Near-duplicates by the exact Jaccard index of word shingles, with candidates from SimHash links and from least hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import (
    TEXTS_A_TASK,
    arrow_schema,
    bounded_batches,
    encoded,
    gathered,
    map_batches,
    mixed,
    partitions,
    record_batch,
    stored,
)
from tablesync.llm.components import components
from tablesync.llm.simhash import FLUSH, _majority, fingerprints_of_hashes, links

WORDS = 8
BITS = 64 * WORDS
#: Of each text BANDS keys, each of BAND_ROWS least hashes: texts at 0.8 share one with a chance of 1 - (1 - 0.8 ** 3) ** 16,
#: at every number of documents.
BANDS, BAND_ROWS = 16, 3
MISSED = (1 - 0.8**BAND_ROWS) ** BANDS
#: Turns in which one node of each key stands for the others, and rows of a key that are compared pair by pair in one group.
STARS, SMALL = 2, 2048
#: And of their shingles: a longer text is a block of its own.
SMALL_BYTES = 1 << 24
#: Texts whose shingle hashes are held at a time.
MARKED = 1000
#: Differing bits of the 64 up to which SimHash links texts.
LINK_BITS = 4
#: Bytes of the batches that go to Python: texts and shingle sets are long, and each is held several times there.
BATCH_BYTES = 1 << 22
#: Standard deviations of the distance above its mean that still count as near.
DEVIATIONS = 4


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """XXH64 of the word shingles, A-Z lower-cased; with fewer words, of the whole sequence."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    places = zip((ends - sizes).tolist(), ends[shingle_words - 1 :].tolist(), strict=False)
    return np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in places], np.uint64)


def wide_fingerprints_of(every_hash: list[np.ndarray]) -> np.ndarray:
    """WORDS words of 64 bits per text from its shingle hashes; each word is a SimHash over the hashes mixed anew."""
    result = np.zeros((len(every_hash), WORDS), np.uint64)
    hashes, lengths, places = [], [], []

    def flush() -> None:
        if lengths:
            every, sizes = np.concatenate(hashes), np.array(lengths, np.int64)
            for k in range(WORDS):
                with np.errstate(over="ignore"):
                    result[places, k] = _majority(mixed(every + np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1)), sizes)
            hashes.clear(), lengths.clear(), places.clear()

    for k, found in enumerate(every_hash):
        if len(found):
            hashes.append(found), lengths.append(len(found)), places.append(k)
            if sum(lengths) >= FLUSH:
                flush()
    flush()
    return result


def most_bits(similarity: float) -> int:
    """Differing bits up to which texts can be that similar: what is expected for that Jaccard index, and DEVIATIONS."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(BITS * share + DEVIATIONS * math.sqrt(BITS * share * (1 - share)))


def least_hashes_of(every_hash: list[np.ndarray]) -> list[np.ndarray]:
    """BANDS keys per text from its shingle hashes, each made of BAND_ROWS least shingle hashes under a mix of its own; none for a text without words."""
    result: list[np.ndarray] = [np.zeros(0, np.int64)] * len(every_hash)
    hashes, places, held = [], [], 0

    def flush() -> None:
        if not places:
            return
        every, first = np.concatenate(hashes), np.cumsum([0, *map(len, hashes[:-1])])
        keys = np.zeros((len(places), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(BANDS):
                key = np.full(len(places), np.uint64(k))
                for j in range(BAND_ROWS):
                    turn = np.uint64((k * BAND_ROWS + j + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1)
                    key = mixed(key ^ np.minimum.reduceat(mixed(every ^ turn), first))
                keys[:, k] = key
        for at, row in zip(places, keys.view(np.int64), strict=True):
            result[at] = row
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


def shingle_set(text: bytes, shingle_words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle_words))


def node_of(shingles: np.ndarray) -> int:
    """Texts with the same shingles are one node."""
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), np.uint64).view(np.int64))


def _near(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Whether rows of words differ in at most ``limit`` bits."""
    return np.bitwise_count(a ^ b).sum(axis=1) <= limit


def _words_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, WORDS)


def near_pairs(pairs: DataFrame, classes: DataFrame, limit: int, rows: int) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes whose fingerprints differ in at most ``limit`` bits. There are ``rows`` pairs and classes at most."""

    def near(columns: dict) -> dict:
        hit = pa.array(_near(_words_of(columns["fp_a"]), _words_of(columns["fp_b"]), limit))
        return {"a": columns["a"].filter(hit), "b": columns["b"].filter(hit)}

    left = classes.select(F.col("node").alias("a"), F.col("fp").alias("fp_a"))
    right = classes.select(F.col("node").alias("b"), F.col("fp").alias("fp_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "fp_a", "fp_b")
    return map_batches(gathered(both, rows), near, "a long, b long")


def shingle_sets(wanted: DataFrame, marked: DataFrame, keyed: DataFrame, shingle_words: int) -> DataFrame:
    """``node`` and ``shingles`` (sorted hashes as bytes) for the nodes of a frame, from one text of each. ``marked`` is stored."""
    chosen = marked.select("id", "digest", "more", "node").join(wanted.select("node").distinct(), "node").dropDuplicates(["node"])
    known = F.coalesce(F.col("id"), F.lit((1 << 63) - 1))
    place = ["key", "digest", "more"]
    texts = keyed.withColumn("key", known).select(*place, "text").join(chosen.select(known.alias("key"), "digest", "more", "node"), place)
    texts = texts.dropDuplicates(place)  # dealt by place already, so rows alike go without a shuffle of what is made of them

    def sets(columns: dict) -> dict:
        found = [shingle_set(t, shingle_words) for t in encoded(columns["text"])]
        own = [k for k, (s, n) in enumerate(zip(found, columns["node"].to_pylist(), strict=True)) if node_of(s) == n]
        return {"node": columns["node"].take(pa.array(own, pa.int64())), "shingles": [found[k].tobytes() for k in own]}

    return map_batches(gathered(texts.select("node", "text"), marked.count(), TEXTS_A_TASK), sets, "node long, shingles binary")


def _alike(one: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether sets have a Jaccard index of ``similarity`` or more with one; all are sorted."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    every = np.concatenate(others)
    place = np.searchsorted(one, every)
    place[place == len(one)] = 0
    both = np.add.reduceat((one[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return both >= similarity * (len(one) + sizes - both) - 1e-9


def exact_links(pairs: DataFrame, marked: DataFrame, keyed: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """The pairs, a stored table, whose shingle sets have a Jaccard index of ``similarity`` or more, from the texts themselves."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    known_sets = stored(shingle_sets(wanted, marked, keyed, shingle_words), "widehash-sets")

    def alike(columns: dict) -> dict:
        hit = [
            bool(_alike(np.frombuffer(x.as_py(), np.uint64), [np.frombuffer(y.as_py(), np.uint64)], similarity)[0])
            for x, y in zip(columns["x"], columns["y"], strict=True)
        ]
        keep = pa.array(hit, pa.bool_())
        return {"a": columns["a"].filter(keep), "b": columns["b"].filter(keep)}

    left = known_sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = known_sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return map_batches(gathered(both, 2 * pairs.count(), TEXTS_A_TASK), alike, "a long, b long")


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Of every key one node, another one each turn, paired with those of other components."""
    order = F.xxhash64("node", F.lit(turn))
    one = rows.groupBy("key").agg(F.min(order).alias("least"))
    first = rows.withColumn("order", order).join(one, "key").where("order = least").groupBy("key").agg(F.min("node").alias("a"), F.min("root").alias("root_a"))
    return rows.join(first, "key").where("root <> root_a").select("a", F.col("node").alias("b")).distinct()


def _forest(nodes: list, roots: list, fps: np.ndarray, sets: list[np.ndarray], split: int, limit: int, similarity: float) -> tuple[list, list]:
    """Verified links that tie what all links of a group tie, one less than the components they join.

    Members are compared with those of other components only, and links join components as they are found. With a
    ``split`` below the number of members, those before it are compared with those after it.
    """
    _, part = np.unique(np.array(roots), return_inverse=True)
    a, b = [], []
    whole = split == len(nodes)
    for k in range(split):
        others = np.arange(k + 1 if whole else split, len(nodes))
        others = others[part[others] != part[k]]
        others = others[_near(fps[others], fps[k][None, :], limit)]
        if not len(others):
            continue
        linked = others[_alike(sets[k], [sets[j] for j in others.tolist()], similarity)]
        tied, first = np.unique(part[linked], return_index=True)
        for j in linked[first].tolist():
            a.append(nodes[k]), b.append(nodes[j])
        part[np.isin(part, tied)] = part[k]
    return a, b


def rest_links(rows: DataFrame, limit: int, similarity: float) -> DataFrame:
    """Verified links ``a``, ``b`` that tie what all pairs of different components within a key tie.

    ``rows`` has key, node, root, fp and shingles. A key is handled in one group, which gives a forest, never its pairs. One with over
    SMALL rows or SMALL_BYTES of shingles is dealt into blocks, and every two of its blocks (and each with itself) meet in a
    group of their own, so no task holds more than two blocks, and each gives fewer links than it has rows.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / SMALL, F.sum(F.length("shingles")) / SMALL_BYTES)).cast("long").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    dealt = rows.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = dealt.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root", "fp", "shingles"
    ).repartition(partitions(spark), "key", "low", "high").sortWithinPartitions("key", "low", "high", "own", "node")
    schema = "a long, b long"
    target = arrow_schema(spark, schema)

    def solve(group: list[tuple]) -> pa.RecordBatch:
        """One group, its first block before the other."""
        _, low, high, first, nodes, roots, fps, shingles = zip(*group)
        split = len(group) if low[0] == high[0] else sum(o == low[0] for o in first)
        words = np.frombuffer(b"".join(fps), "<u8").reshape(-1, WORDS)
        a, b = _forest(list(nodes), list(roots), words, [np.frombuffer(x, np.uint64) for x in shingles], split, limit, similarity)
        return record_batch({"a": a, "b": b}, target)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups from sorted rows."""
        waiting: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if waiting and waiting[0][:3] != row[:3]:
                    if len(waiting) > 1:
                        yield solve(waiting)
                    waiting = []
                waiting.append(row)
        if len(waiting) > 1:
            yield solve(waiting)

    links = placed.mapInArrow(groups, schema)
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_keys(classes: DataFrame) -> DataFrame:
    """``key`` and ``node``: nodes whose 64-bit fingerprints SimHash links, directly or through others, share a key.

    The links are those of operator 2, by pigeonring, so every pair within LINK_BITS has the same key. Nodes without shingles have none.
    """
    known = classes.where("sim IS NOT NULL").select("node", F.col("sim").alias("fp"))
    distinct = stored(gathered(known.select("fp").distinct(), classes.count()), "widehash-fps")
    tied = stored(components(links(distinct, LINK_BITS)), "widehash-tied")
    rooted = known.join(tied, known["fp"] == tied["node"]).select(F.xxhash64(F.lit("simhash"), tied["root"]).alias("key"), known["node"])
    alone = known.join(tied, known["fp"] == tied["node"], "left_anti").select(F.xxhash64(F.lit("simhash"), "fp").alias("key"), "node")
    return rooted.union(alone)


def similar_roots(marked: DataFrame, keyed: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """``node`` and ``root`` for the nodes linked with others, directly or through others, by their exact Jaccard index.

    ``marked`` has id, digest, more, node, fp, sim and keys per document, ``keyed`` id, digest, more and text. Nodes that share a key
    are candidates: SimHash gives one to all that its links tie, least hashes give the others. First, in STARS turns, one node of each key is compared with the others, which ties most of a large group together
    in as many rows as it has. What is left of a key with several components is compared within groups that give
    forests of verified links. None is left out but those of texts without a common key (MISSED of the pairs at 0.8, less
    above) or with fingerprints over the limit. Null ids stand for the greatest; an empty table gives no rows.
    """
    limit = most_bits(similarity)
    classes = stored(gathered(marked.select("node", "fp", "sim", "keys").dropDuplicates(["node"]), marked.count()), "widehash-classes")
    nodes = classes.count()
    keys = classes.select(F.explode("keys").alias("key"), "node").union(simhash_keys(classes))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    rows = stored(gathered(keys.join(shared, "key"), (BANDS + 1) * nodes), "widehash-keys")
    n_rows = rows.count()
    roots: DataFrame | None = None

    def open_rows() -> DataFrame:
        """Rows of keys whose nodes are in more than one component."""
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        rooted = rows.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        return stored(gathered(rooted.join(several, "key"), n_rows), "widehash-open")

    def tie(links: DataFrame) -> DataFrame:
        """Components with new links: those there are count as one link per node."""
        every = links if roots is None else links.union(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
        return stored(components(every, links.count() + (0 if roots is None else roots.count())), "widehash-roots")

    for turn in range(STARS):
        pairs = near_pairs(_star_pairs(open_rows(), turn), classes, limit, n_rows + nodes)
        roots = tie(stored(exact_links(stored(pairs, "widehash-pairs"), marked, keyed, similarity, shingle_words), "widehash-links"))
    left = open_rows()
    sets = stored(shingle_sets(left, marked, keyed, shingle_words), "widehash-sets")
    full = left.join(classes.select("node", "fp"), "node").join(sets, "node")
    return tie(stored(gathered(rest_links(full, limit, similarity), left.count()), "widehash-links"))


def keep_one_of_similar(
    docs: DataFrame, similarity: float = 0.8, shingle_words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The input rows without near-duplicates: of each group the document with the smallest id stays, of equal rows one.

    Texts are linked if their sets of word shingles have a Jaccard index of ``similarity`` or more. Candidates come from operator 2, the
    pigeonring join of SimHash fingerprints, and, as texts at ``similarity`` seldom come that near, from least hashes of the shingles, too; they
    pass a loose limit on the bits of long SimHash fingerprints, and the sets themselves decide. Texts with the same set are one node. Defined cases: a null id is greater than all others; texts without words are one group;
    an empty table gives no rows; all columns stay as they are.
    """
    known_text = F.coalesce(F.col(text_col), F.lit(""))
    # Together 128 bits, which tell the texts of one id (or of none) apart.
    digests = [F.xxhash64(known_text).alias("digest"), F.xxhash64(F.lit(1), known_text).alias("more")]
    place = ["key", "digest", "more"]
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *digests)

    def marks(columns: dict) -> dict:
        found: dict[str, list] = {"node": [], "fp": [], "sim": [], "keys": []}
        texts = encoded(columns["text"])
        for first in range(0, len(texts), MARKED):
            hashes = [shingle_hashes(t, shingle_words) for t in texts[first : first + MARKED]]
            found["node"] += [node_of(np.unique(h)) for h in hashes]
            found["fp"] += [row.astype("<u8").tobytes() for row in wide_fingerprints_of(hashes)]
            sims = fingerprints_of_hashes(hashes).view(np.int64).tolist()
            found["sim"] += [s if len(h) else None for s, h in zip(sims, hashes, strict=True)]
            found["keys"] += least_hashes_of(hashes)
        return {name: columns[name] for name in ("id", "digest", "more")} | found

    spec = "id long, digest long, more long, node long, fp binary, sim long, keys array<long>"
    with bounded_batches(docs.sparkSession, BATCH_BYTES):
        marked = stored(map_batches(keyed, marks, spec), "widehash")
        roots = similar_roots(marked, keyed, similarity, shingle_words)
    rooted = marked.select("id", "digest", "more", "node").join(roots, "node", "left")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "digest", "more")
    keepers = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(order).alias("least")).select("least.id", "least.digest", "least.more")
    known = F.coalesce(F.col("id"), F.lit((1 << 63) - 1))
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), *digests)
    kept = whole.withColumn("key", known).join(keepers.select(known.alias("key"), "digest", "more"), place, "left_semi")
    return kept.dropDuplicates(place).select("row.*")
