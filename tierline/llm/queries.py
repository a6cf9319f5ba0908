"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm.byte_bpe import encode_documents
from tierline.llm.embedding_dedup import near_vectors
from tierline.llm.exact_dedup import exact_groups
from tierline.llm.filter_audit import audit_filters, audit_filters_sql
from tierline.llm.language_id import identify
from tierline.llm.line_dedup import dedup_lines, dedup_lines_sql
from tierline.llm.minhash import near_duplicates
from tierline.llm.mixing import mixture, mixture_sql
from tierline.llm.ngram_lm import score_documents
from tierline.llm.passage_dedup import repeated_passages
from tierline.llm.prefix_trie import prefix_trie, prefix_trie_sql
from tierline.llm.token_files import read_digests, write_tokens
from tierline.llm.topk_search import top_products, top_products_sql

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_documents(spark, sf_dir)).drop("row_key")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_digests(write_tokens(_documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), added_tokens=True))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_documents(spark, sf_dir))


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_exact_dedup, op2_lm_scoring, op3_embedding_dedup, op4_source_mixing, op5_minhash_dedup,
    op6_token_files, op7_byte_bpe, op8_line_dedup, op9_language_id, op10_passage_dedup,
    op11_filter_audit, op12_topk_search, op13_prefix_trie)}

EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
           FROM documents),
g AS (SELECT doc_id, s, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS n FROM d)
SELECT doc_id, keep_id, n AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, s AS text_sha256 FROM g"""

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": EXACT_SQL,
    "op4_source_mixing": mixture_sql(),
    "op8_line_dedup": dedup_lines_sql(),
    "op11_filter_audit": audit_filters_sql(),
    "op12_topk_search": top_products_sql(),
    "op13_prefix_trie": prefix_trie_sql(),
}
