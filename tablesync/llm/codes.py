"""Vector codes: product quantisation on integers, with dot products that are exact in floating point."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, record_batch, stored

#: Every whole number up to here is a double.
EXACT = 1 << 53
#: Integer components beyond this are refused: squared distances and their sums stay within 64 bits below it.
LARGEST = 1 << 27
#: Vectors that are compared with all entries at a time.
BLOCK = 2048
#: A table of label sums with no more rows than this is broadcast.
FEW_LABELS = 100_000


def limb_bits(width: int) -> int:
    """The widest limbs for which a dot product of ``width`` limb products stays below 2^53."""
    bits = 26
    while width << (2 * bits) >= EXACT:
        bits -= 1
    return bits


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as doubles in base ``2^bits``, lowest first: the last one carries the sign, those before lie in 0 to base - 1."""
    out, rest = [], values
    while True:
        if not rest.size or (rest.max() < 1 << bits and rest.min() >= -(1 << bits)):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of 64-bit integers: one float64 matrix product for each pair of limbs, put together in int64."""
    bits = limb_bits(max(a.shape[-1], 1))
    total: np.ndarray | int = 0
    for i, low in enumerate(limbs(a, bits)):
        for j, high in enumerate(limbs(b, bits)):
            total = total + (np.matmul(low, high).astype(np.int64) << (bits * (i + j)))
    return np.asarray(total, np.int64)


def nearest(cut: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For vectors (n, parts, width) and codebooks (parts, entries, width): each part's nearest entry and its squared
    distance, both (n, parts). Of entries equally near, the first."""
    codes = np.zeros(cut.shape[:2], np.int64)
    errors = np.zeros(cut.shape[:2], np.int64)
    flipped, squares = books.transpose(0, 2, 1), (books * books).sum(axis=2)
    for at in range(0, len(cut), BLOCK):
        some = cut[at : at + BLOCK].transpose(1, 0, 2)
        distance = squares[:, None, :] - 2 * exact_products(some, flipped)
        best = distance.argmin(axis=2)
        codes[at : at + BLOCK] = best.T
        least = np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0]
        errors[at : at + BLOCK] = (least + (some * some).sum(axis=2)).T
    return codes, errors


def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite components, and the floors of their scaled components."""
    sizes = np.asarray(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    fine = np.asarray(vectors.is_valid().to_numpy(zero_copy_only=False), bool)
    fine[owner[~np.isfinite(values)]] = False
    kept_sizes = sizes[fine]
    if len(kept_sizes) and kept_sizes.min() != kept_sizes.max():
        raise ValueError(f"Vectors of {kept_sizes.min()} and of {kept_sizes.max()} components in one table.")
    scaled = np.floor(values[fine[owner]] * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"A component times {scale} lies beyond {LARGEST}: scale the vectors down.")
    return fine, scaled.astype(np.int64).reshape(len(kept_sizes), int(kept_sizes[0]) if len(kept_sizes) else 0)


def _in_parts(values: np.ndarray, parts: int) -> np.ndarray:
    if values.shape[1] % parts:
        raise ValueError(f"{values.shape[1]} components do not make {parts} equal parts.")
    return values.reshape(len(values), parts, values.shape[1] // parts)


def seeds(vectors: DataFrame, parts: int, entries: int, scale: int = 256) -> np.ndarray:
    """The first codebooks: the parts of the kept vectors with the smallest ids, equal ids by their components."""
    schema = arrow_schema(vectors.sparkSession, "vec_id long, whole array<long>")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, values = integers(batch.column(1), scale)
            ids = batch.column(0).filter(pa.array(fine))
            whole = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]) if values.size else [[]] * len(values)
            yield record_batch({"vec_id": ids, "whole": whole}, schema)

    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(kept, "vec_id long, whole array<long>")
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).collect()
    values = np.array([r["whole"] for r in least], np.int64).reshape(len(least), -1 if least else 0)
    return _in_parts(values, parts).transpose(1, 0, 2) if least else np.zeros((parts, 0, 0), np.int64)


def train_codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> np.ndarray:
    """Codebooks (parts, entries, width) after some rounds over all vectors.

    A round is one scan: a task adds up the parts it assigns to each entry and sends on only these sums, parts x entries x width
    numbers whatever it has read. Sums of integers do not depend on the order of tasks, so reruns agree.
    """
    spark = vectors.sparkSession
    books = seeds(vectors, parts, entries, scale)
    schema = arrow_schema(spark, "entry int, place int, total long, used long")
    for _ in range(rounds if books.size else 0):
        def tally(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            flat = books.shape[0] * books.shape[1]
            totals, used = np.zeros((flat, books.shape[2]), np.int64), np.zeros(flat, np.int64)
            for batch in batches:
                cut = _in_parts(integers(batch.column(0), scale)[1], parts) if batch.num_rows else None
                if cut is None or not len(cut):
                    continue
                at = (nearest(cut, books)[0] + np.arange(parts) * books.shape[1]).ravel()
                np.add.at(totals, at, cut.reshape(-1, cut.shape[2]))
                used += np.bincount(at, minlength=flat)
            entry, place = np.nonzero(np.repeat(used[:, None] > 0, books.shape[2], axis=1))
            yield record_batch({"entry": entry, "place": place, "total": totals[entry, place], "used": used[entry]}, schema)

        sums = vectors.select("embedding").mapInArrow(tally, "entry int, place int, total long, used long")
        # As many rows as the codebooks have components.
        rows = sums.groupBy("entry", "place").agg(F.sum("total").alias("total"), F.sum("used").alias("used")).collect()
        moved = books.reshape(-1, books.shape[2]).copy()
        for r in rows:
            moved[r["entry"], r["place"]] = r["total"] // r["used"]
        books = moved.reshape(books.shape)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, books: np.ndarray, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error``, the squared distance to what the code stands for."""
    spec = "vec_id long, label int, code string, error long"
    schema, parts = arrow_schema(vectors.sparkSession, spec), books.shape[0]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, values = integers(batch.column(2), scale)
            if not len(values):
                continue
            codes, errors = nearest(_in_parts(values, parts), books)
            text = codes.astype(np.uint8).tobytes().hex()
            kept = pa.array(fine)
            yield record_batch(
                {
                    "vec_id": batch.column(0).filter(kept),
                    "label": batch.column(1).filter(kept),
                    "code": [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)],
                    "error": errors.sum(axis=1),
                },
                schema,
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "embedding")
    return rows.mapInArrow(encode, spec)


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """Codes of all vectors with codebooks trained on all of them.

    Null vectors and those with a null or non-finite component are left out. A vector without an id is kept, but starts
    no entry; equal ids come in the order of their components; with fewer vectors than entries there are fewer entries.
    Vectors of another length than the others, a length that ``parts`` does not divide, and scaled components beyond 2^27 are
    refused. Labels are added up with nulls as one of them: the sums are broadcast only where they are few, else joined by
    label, where adaptive execution splits a label that very many vectors have.
    """
    if entries > 256:
        raise ValueError("A code holds two hex digits a part: at most 256 entries.")
    books = train_codebooks(vectors, parts, entries, rounds, scale)
    coded = stored(encode_vectors(vectors, books, scale), "codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    side = sums.select(F.col("label").alias("of_label"), "label_error")
    if sums.count() <= FEW_LABELS:
        side = F.broadcast(side)
    joined = coded.join(side, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
