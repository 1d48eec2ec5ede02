"""The registered queries over whole tables, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bit_planes, bpe_automaton, collocations, context_tree, jaccard_join, language_id, license_scan, main_text, mixing, target_resampling, token_counts, topk_search, vector_dedup
from .base import table


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents")).drop("spans")


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.deduplicated(table(spark, sf_dir, "embeddings"))


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(table(spark, sf_dir, "documents"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.written(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


def like_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": licences,
        "op2_context_tree_score": language_model,
        "op3_topk_search": nearest,
        "op4_vector_dedup": near_vectors,
        "op5_bpe_automaton": bpe,
        "op6_source_mixing": mix,
        "op7_ngram_jaccard_join": near_copies,
        "op8_language_id": languages,
        "op9_token_counts": tokens,
        "op10_main_text": main_texts,
        "op11_bit_planes": token_files,
        "op12_collocations": phrases,
        "op13_target_resampling": like_benchmark,
    }


def statements() -> dict[str, str]:
    return {"op3_topk_search": topk_search.SQL, "op4_vector_dedup": vector_dedup.SQL, "op6_source_mixing": mixing.SQL, "op12_collocations": collocations.SQL}
