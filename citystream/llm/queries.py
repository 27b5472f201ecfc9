"""The operators' queries over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citystream.llm import curves, exact_dedup, fim, language_id, licenses, packing, repair, sentencepiece_codec, sharding, simhash, substring_dedup, token_counts, topk
from citystream.sources.tables import table

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
SEQUENCE_TOKENS = 2048
TOKEN_LIMIT = 1024
SHARDS = 8

#: Top-k search: scale of the vectors' whole numbers, divisor of query ids, results.
VECTOR_SCALE, QUERY_EVERY, BEST = 256, 50, 5

#: Nearest neighbours: divisor of query ids, results.
NEAR_EVERY, NEAREST = 100, 10

#: SimHash: words of a shingle, and bits that linked fingerprints may differ in.
SHINGLE_WORDS = 4
MOST_BITS = 4

#: Fill-in-middle: markers, seed of the hash, of 100 texts those cut, of 100 cut ones those with the suffix first.
FIM = fim.Plan("<P>", "<S>", "<M>", 42, 50, 80, fim.WORD)

#: Words of a window of substring dedup.
WINDOW_WORDS = 13

#: Documents and attention never bind before tokens do (a piece has a token at
#: least, and squares of parts stay below the square of their sum).
SEQUENCE = packing.Capacity(SEQUENCE_TOKENS, SEQUENCE_TOKENS, SEQUENCE_TOKENS ** 2)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), SEQUENCE)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), VECTOR_SCALE, QUERY_EVERY, BEST)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), TOKEN_LIMIT)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predictions(docs, language_id.fitted(docs))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(table(spark, sf_dir, "documents"), WINDOW_WORDS)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MOST_BITS)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"), FIM)


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.neighbours(table(spark, sf_dir, "embeddings"), NEAR_EVERY, NEAREST)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_exact_top_k, op3_sharding, op4_sentencepiece, op5_token_counts, op6_exact_dedup, op7_language_id, op8_substring_dedup, op9_license_scan,
                         op10_simhash_near_dedup, op11_fill_in_middle, op12_nearest_neighbours, op13_conversation_repair)
}

#: Of every query that SQL can express, the same rows from DuckDB.
ORACLE: dict[str, str] = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        g AS (
            SELECT norm, count(*) AS group_size, max(n) AS most FROM d GROUP BY norm),
        k AS (
            SELECT d.norm, min(d.doc_id) AS keep_id
            FROM d JOIN g ON d.norm = g.norm AND d.n = g.most GROUP BY d.norm)
        SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, sha256(d.norm) AS text_sha256
        FROM d JOIN g ON d.norm = g.norm JOIN k ON d.norm = k.norm""",
    "op8_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        f AS (SELECT win, min(doc_id) AS first_id FROM s GROUP BY win),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS j
            FROM s JOIN f USING (win), range(0, 13) r(k) WHERE s.doc_id > f.first_id),
        p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
        kept AS (
            SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.j) AS t, count(*) AS n
            FROM p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.j WHERE g.j IS NULL GROUP BY p.doc_id)
        SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
}
