"""Draw documents that look like a target: importance weights from hashed word features, and a draw without replacement."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, encoded, record_batch, running_total, stored

#: After lower-casing, in UTF-8: digits, letters and every byte of a character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Stands between the joined texts of a batch; no word holds it.
SENTINEL = b"\x00"
#: Words that are turned into numbers at a time, whatever the length of the texts.
WORDS_AT_ONCE = 1 << 17
ONES = np.uint32(0xFFFFFFFF)
#: The byte-wise step of CRC-32, from the checksums of single bytes.
STEP = np.array([crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)


def after_space(sums: np.ndarray) -> np.ndarray:
    """The CRC-32 of ``x + b" "`` from that of ``x``."""
    inner = sums ^ ONES
    return STEP[(inner ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (inner >> np.uint32(8)) ^ ONES


def features(texts: list[bytes], buckets: int, longest: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The hashed runs of 1 to ``longest`` words of a batch of texts.

    The texts are joined and searched in one pass; where a word starts tells its text, and runs over the
    border of two texts are masked out. Yields for a bounded number of words at a time: the texts of the words, the texts of
    the runs, the buckets of the runs.
    """
    joined = SENTINEL.join(texts).lower()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    found = WORD.finditer(joined)
    owners_before = np.full(longest - 1, -1, np.int64)
    sums_before = np.zeros(longest, np.uint32)
    while block := list(islice(found, WORDS_AT_ONCE)):
        n = len(block)
        words = [match[0] for match in block]
        starts = np.fromiter((match.start() for match in block), np.int64, n)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        known = np.concatenate([owners_before, owner])
        sums = np.fromiter(map(crc32, words), np.uint32, n)
        owners, hashed = [owner], [sums]
        for size in range(2, longest + 1):
            shorter = np.concatenate([sums_before[size - 2 : size - 1], sums[:-1]])
            sums_before[size - 2] = sums[-1]
            sums = np.fromiter(map(crc32, words, after_space(shorter).tolist()), np.uint32, n)
            first = longest - size
            whole = known[first : first + n] == owner
            owners.append(owner[whole])
            hashed.append(sums[whole])
        owners_before = known[n:]
        yield owner, np.concatenate(owners), np.concatenate(hashed).astype(np.int64) % buckets


def feature_counts(texts: DataFrame, text: str = "text", buckets: int = 10_000, longest: int = 2) -> np.ndarray:
    """How often each bucket occurs in all texts; a task sends its sums only."""
    schema = arrow_schema(texts.sparkSession, "bucket int, n long")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, bucket in features(encoded(batch.column(0)), buckets, longest):
                counts += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(counts)
        yield record_batch({"bucket": held, "n": counts[held]}, schema)

    rows = texts.select(text).mapInArrow(tally, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most as many as there are buckets
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of a bucket's smoothed shares in target and source, floored."""
    of_source, of_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * of_source / ((float(s) + 1) * of_target)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def luck(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths: the k highest scores are a draw without replacement by weight."""
    drawn = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def scored_documents(docs: DataFrame, gains: np.ndarray, seed: int = 7, longest: int = 2) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    spec = "doc_id long, n_words long, n_features long, weight long, score long"
    schema, buckets = arrow_schema(docs.sparkSession, spec), len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(1))
            words, runs, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for owner, owners, bucket in features(texts, buckets, longest):
                words += np.bincount(owner, minlength=len(texts))
                runs += np.bincount(owners, minlength=len(texts))
                # Sums of whole numbers far below 2^53 are exact.
                total += np.bincount(owners, weights=gains[bucket], minlength=len(texts)).astype(np.int64)
            weight = total // np.maximum(runs, 1)
            noise = np.array([luck(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            yield record_batch(
                {"doc_id": batch.column(0), "n_words": words, "n_features": runs, "weight": weight, "score": weight + noise}, schema
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, spec)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    buckets: int = 10_000,
    longest: int = 2,
    seed: int = 7,
) -> DataFrame:
    """Importance weights of all documents toward the texts of ``target``, and the drawn ones' ranks.

    Two scans of the documents: bucket counts, then scores. Ranks need no order of all rows: scores are whole numbers in
    a range that the logarithms bound, so the documents above each score are known from a small table of counts, and only
    documents with the same score are put in order among each other.

    A null text has no words, weight 0 and is never drawn while ``least_words`` is positive; a null id draws the
    noise of an empty id and comes last of equal scores; rows with the same id, text and so score get ranks in any
    order. With no target texts or no documents the counts are zero, and all holds as stated.
    """
    gains = bucket_gains(feature_counts(docs, "text", buckets, longest), feature_counts(target, "text", buckets, longest))
    scored = stored(scored_documents(docs, gains, seed, longest), "resampling")
    able = F.col("n_words") >= least_words
    counts = stored(scored.where(able).groupBy("score").agg(F.count("*").alias("n"), (-F.col("score")).alias("down")), "scores")
    eligible = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    wanted = percent * eligible // 100
    above = running_total(counts, [], "down", "n", "above").where(F.col("above") < wanted).select(F.col("score").alias("s"), "above")
    # One row per score: their range is bounded, whatever the number of documents.
    placed = scored.join(F.broadcast(above), able & (F.col("score") == F.col("s")), "left")
    results = ["doc_id", "n_features", "weight", "score"]
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    near = placed.where("s IS NOT NULL").withColumn("rank", F.col("above") + F.row_number().over(order))
    drawn = near.select(*results, F.when(F.col("rank") <= wanted, F.col("rank")).cast("long").alias("rank"))
    return drawn.unionByName(placed.where("s IS NULL").select(*results, F.lit(None).cast("long").alias("rank")))
