"""The corpus pipeline: stages over `documents`, each on all that the one before kept.

Language ID drops texts without a letter and those that the network takes for no
learnt language, by a limit that is calibrated on labelled windows; exact dedup keeps one document of equal texts; SimHash
near-dedup keeps one document of each linked group; substring dedup takes words
of repeated windows out of the texts (rows stay, n_chars follows the text);
best-fit packing lays the documents out in sequences. All but the last return
the columns of their input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citystream.llm import exact_dedup, language_id, packing, queries, simhash, substring_dedup
from citystream.session import bounded_batches, scratch_path
from citystream.sources.tables import table


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return language_id.identified(docs, language_id.fitted(docs))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return simhash.first_of_groups(docs, queries.SHINGLE_WORDS, queries.MOST_BITS)


def substring_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return substring_dedup.deduplicated(docs, queries.WINDOW_WORDS, length_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path(queries.BYTE_BPE), queries.SEQUENCE)


STAGES = [
    ("language_id", language_identification),
    ("exact_dedup", exact_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_deduplication),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the trained classifier, the tokenizer and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
