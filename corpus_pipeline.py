"""From documents to token ids: drop what is in no known language, keep one of near copies, mix sources, encode."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe_automaton, jaccard_join, language_id, mixing
from millrace.llm.base import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that language identification doesn't reject."""
    return language_id.kept(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return mixing.drawn(docs, table(spark, sf_dir, "labels"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and digests of ids and of the decoded text."""
    return bpe_automaton.encoded(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mixing", mixed_sources),
    ("bpe", encoded),
]
#: Language identification and encoding are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
