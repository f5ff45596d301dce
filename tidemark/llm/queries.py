"""Registered queries of the operators: each applies one with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from . import (bpe_op, classifier_op, conversation_op, embedding_op, fingerprint_op, html_op, mixing_op, ngram_join_op, phrase_op, pii_op, quality_op, substring_op,
               token_count_op)
from .common import table
from .oracles import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Vocabulary files, read where the workers have the public tokenizers installed.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[name] = run
        return run
    return add


@query("op1_substring_dedup")
def substring_dedup(spark, sf_dir):
    """Words covered by 20-word windows that start earlier too, removed."""
    return substring_op.digest(substring_op.substring_dedup(table(spark, sf_dir, "documents"), 20))


@query("op2_ngram_jaccard")
def ngram_jaccard(spark, sf_dir):
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join_op.digest(ngram_join_op.jaccard_components(table(spark, sf_dir, "documents"), 3, 90))


@query("op3_mix_sources")
def mix_sources(spark, sf_dir):
    """Words that a mix by source weights takes of every document."""
    return mixing_op.mix(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def quality_classifier(spark, sf_dir):
    """Probability that a document is of good quality."""
    return classifier_op.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_embedding_dedup")
def embedding_dedup(spark, sf_dir):
    """Links and components of vectors with a cosine of 0.95 or more."""
    return embedding_op.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@query("op6_quality_rules")
def quality_rules(spark, sf_dir):
    """Base counts and the verdict of the compression bands."""
    return quality_op.rate(table(spark, sf_dir, "documents"))


@query("op7_html_text")
def html_text(spark, sf_dir):
    """Main text of every page."""
    return html_op.digest(html_op.extract(table(spark, sf_dir, "pages")))


@query("op8_pii")
def pii(spark, sf_dir):
    """Personal data of every document."""
    return pii_op.digest(pii_op.find(table(spark, sf_dir, "documents")))


@query("op9_bpe")
def bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, and what they decode to."""
    return bpe_op.digest(bpe_op.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE))


@query("op10_token_counts")
def token_counts(spark, sf_dir):
    """Pieces of every document."""
    return token_count_op.digest(token_count_op.token_counts(table(spark, sf_dir, "documents"), PIECE_BPE))


@query("op13_conversation_trie")
def conversation_trie(spark, sf_dir):
    """Nodes of the prefix trie of the rebuilt conversations."""
    return conversation_op.digest(conversation_op.prefix_trie(conversation_op.rebuilt(table(spark, sf_dir, "conversations"))))


@query("op11_phrases")
def phrases(spark, sf_dir):
    """The first 2000 collocations of each language."""
    return phrase_op.top(table(spark, sf_dir, "documents"))


@query("op12_fingerprints")
def fingerprints(spark, sf_dir):
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprint_op.digest(fingerprint_op.neighbours(table(spark, sf_dir, "documents")))
