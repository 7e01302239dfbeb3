"""A training corpus from ``documents``: reject, group, cut, mix and pack, each stage on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablesync import files
from tablesync.llm.mixing import mixed_documents
from tablesync.llm.packing import pack_documents
from tablesync.llm.quality import kept_documents
from tablesync.llm.substrings import without_repeats
from tablesync.llm.widehash import keep_one_of_similar

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.8 or more in five-word shingles, that with the smallest id stays."""
    return keep_one_of_similar(docs, similarity=0.8, shingle_words=5)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that an earlier document has, too, are cut out."""
    return without_repeats(docs, window=13)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their weights."""
    return mixed_documents(docs, weights=(1, 2, 3), max_epochs=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096, one row per piece of a document, with its token ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

#: A fitted forest, hashes for sampling and a tokenizer cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written to the shared folder and read again.

    What a stage stores on its way, and the table it read, are removed when its result is there. Defined cases: a null text is empty
    and, as a text with fewer words than the rules ask for, goes in the first stage; a null id is greater than all others; of
    rows alike one stays; extra columns are carried along up to the last stage; an empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = files.scratch(spark, f"corpus-{name}")
        with files.scratch_run(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            files.delete_tree(spark, before)
        before = path
    return docs
