"""The corpus pipeline: stages over the documents, each a thin call of one operator.

Every stage works on all rows its predecessor kept. Nulls, empty texts, repeated
rows and extra columns pass as the operators' docstrings say: a text without
letters (null and empty ones included) goes in the first stage, of repeated
rows one stays in the second, and other columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, langid, pii, simhash
from tidemark.llm.common import documents
from tidemark.session import scratch_path

# Shingle length in words and maximum bit distance of the near-duplicate stage.
SHINGLE_WORDS, MAX_BITS = 3, 2
VOCABULARY = "byte_bpe_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the corpus; those without letters or unlike any of them go."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the least key."""
    return simhash.keep_first(docs, SHINGLE_WORDS, MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within the edit budget."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked; ``n_chars`` is that of the new text."""
    masked = pii.mask_pii(docs)
    if "n_chars" not in masked.columns:
        return masked
    kind = masked.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the token ids of every text and the digest of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    found = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return found.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_pairs", byte_pairs),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; what one stage returns is stored and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Hash fingerprints, trained models and byte-pair merges have no SQL form.
ORACLE_SQL = None
