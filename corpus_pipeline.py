"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet
in the shared work folder and reads it again as the next one's documents. All but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_op, mixing_op, ngram_join_op, pii_op, quality_op
from tidemark.llm.common import stored, table
from tidemark.session import prepare

#: The n-gram stage: shingles of five words, similarity of 0.8 or more.
WORDS, PERCENT = 5, 80
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and base rules keep."""
    return quality_op.keep_good(docs)


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the group's smallest doc_id."""
    return ngram_join_op.one_of_each(docs, WORDS, PERCENT)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii_op.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each pass over a document."""
    return mixing_op.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, their number, and digests of the ids and of the text that they decode to."""
    coded = bpe_op.round_trip(docs, BYTE_BPE)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("ngram_dedup", ngram_dedup), ("mask_pii", mask_pii), ("mix_sources", mix_sources), ("encode", encode)]

#: Compression, scores and merges have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
