"""The dealt operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from remitmatch.llm import (
    alignment, bpe, cotraining, hilbert, licenses, minhash, pairindex, pq, reversed_search, suffixes, tiling,
    tokenfiles, toxicity,
)
from remitmatch.llm.common import table
from remitmatch.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"))


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_deep_shallow_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op8_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN)


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op11_spill_counted_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op13_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairindex.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_diagonal_license_scan, op2_hilbert_shards, op3_cotrained_quality,
        op4_convolutional_toxicity, op5_product_quantisation, op6_greedy_string_tiling,
        op7_deep_shallow_suffixes, op8_distinct_word_bpe, op9_token_files, op10_circulant_minhash,
        op11_spill_counted_alignment, op12_reversed_search, op13_pair_index_bpe,
    )
}
