"""Corpus pipeline: language ID, exact dedup, MinHash near-dedup, source mixing, byte-level BPE.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. All but the last return the columns of documents (the mix repeats rows it takes
more than once). ``run`` writes every stage as Parquet below ``spark.checkpoint.dir`` and rereads it.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tierline.llm.byte_bpe import encode_documents  # noqa: E402
from tierline.llm.common import bound_batches, written  # noqa: E402
from tierline.llm.exact_dedup import drop_copies  # noqa: E402
from tierline.llm.language_id import keep_identified  # noqa: E402
from tierline.llm.minhash import drop_near_duplicates  # noqa: E402
from tierline.llm.mixing import mixed_documents  # noqa: E402

# Arrow batches: the JVM and the Python workers of an executor hold each of them, beside what the other stages left.
BATCH_BYTES = 4 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (no text, no letter) go."""
    bound_batches(spark, BATCH_BYTES)
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) one document stays."""
    bound_batches(spark, BATCH_BYTES)
    return drop_near_duplicates(docs, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows are repeated up to three times or left out."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the decoded bytes."""
    bound_batches(spark, BATCH_BYTES)
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

# Language ID, near-duplicates and BPE are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
