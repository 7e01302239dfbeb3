"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.frames import local_frame
from tablesync.llm.chat import round_trip
from tablesync.llm.codes import vector_codes
from tablesync.llm.improbable import fingerprint_documents
from tablesync.llm.mixing import mix_sources
from tablesync.llm.packing import pack_documents
from tablesync.llm.pseudo import pseudo_likelihood
from tablesync.llm.quality import judge_documents
from tablesync.llm.resampling import resample
from tablesync.llm.sharding import shard_by_bytes
from tablesync.llm.simhash import near_duplicates
from tablesync.llm.substrings import dedup_substrings
from tablesync.llm.tokens import prefix_token_counts
from tablesync.llm.warc import archive_round_trip

SEQUENCE_LENGTH = 4096
CONTEXT_TOKENS = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages"), min_payload_bytes=0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), max_bits=4, shingle_words=4)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents"), window=13)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(_table(spark, sf_dir, "documents"), shards=24)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_LENGTH)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = prefix_token_counts(_table(spark, sf_dir, "documents"), path, [CONTEXT_TOKENS], keep_steps=False)
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return resample(documents, benchmark, percent=25, least_words=20, buckets=10_000, longest=2, seed=7)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    schema = "conv_id long, turn long, role string, text string"
    more = local_frame(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], schema)
    return round_trip(_table(spark, sf_dir, "conversations").select(*more.columns).unionByName(more))


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_warc,
    op2_simhash,
    op3_fingerprints,
    op4_substrings,
    op5_sharding,
    op6_mixing,
    op7_packing,
    op8_quality,
    op9_pseudo_likelihood,
    op10_token_counts,
    op11_vector_codes,
    op12_resampling,
    op13_chat,
)

ORACLE: dict[str, str] = {}
