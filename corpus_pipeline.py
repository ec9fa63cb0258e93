"""The corpus pipeline: quality rules, exact dedup, near dedup, source mixing, tokens.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its predecessor kept. All but the
last return the columns of documents: rows go in the first three and are repeated or go in the fourth.
The last gives one row per document copy with its tokens' digests.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.llm import bpe, exact_dedup, mixing, quality, simhash
from repolens.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality.quality_filter(docs, policy="v2")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white-space runs as one blank) the one of smallest doc_id."""
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints within 4 bits (shingles of 4 words) the one of smallest doc_id."""
    return simhash.near_dedup(docs, shingle=4, most=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed_rows(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every copy."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(docs, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", tokens),
]

#: SQL can't express the fingerprints' links, the mix or the merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{place}/{i}")
            docs = spark.read.parquet(f"{place}/{i}")
    return docs
