"""Training-data pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns
a frame that is written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.

The stages that compare documents work by row: rows without an id or with an id that other rows have too
get an id of their own for the stage (``by_row``), so they are deduplicated, cut and dropped like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitmatch.llm import bpe, minhash, suffixes, tiling, toxicity
from remitmatch.llm.common import cut, table
from remitmatch.llm.hilbert import ranked

LAST_ID = (1 << 63) - 1


def by_row(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage(docs)`` with a different ``doc_id`` in every row; the ids of ``docs`` are put back after.

    The first row of each id, by a hash of its text, keeps it. The others get ids above all others (below them where
    there is no room), in the order of id, hash and place; they are written once.
    """
    names = docs.columns
    own = docs.withColumn("_own_id", F.col("doc_id").cast("long"))
    repeated = cut(own.groupBy("_own_id").count().where("count > 1 OR _own_id IS NULL"), "repeated")
    span = repeated.agg(F.sum("count").alias("n")).first()["n"]
    if not span:
        return stage(docs)
    ends = own.agg(F.min("_own_id").alias("low"), F.max("_own_id").alias("high")).first()
    high = -1 if ends["high"] is None else ends["high"]
    base = high + 1 if high + span <= LAST_ID else ends["low"] - span
    if base < -LAST_ID - 1:
        raise ValueError("no room for ids of rows that repeat an id")
    same = F.col("_own_id").eqNullSafe(F.col("_their_id"))
    theirs = repeated.select(F.col("_own_id").alias("_their_id"))
    others = ranked(
        own.join(theirs, same, "left_semi").withColumns({
            "_own_text": F.xxhash64(F.coalesce("text", F.lit(""))), "_own_place": F.monotonically_increasing_id()}),
        ["_own_id", "_own_text", "_own_place"])
    firsts = others.where("_own_id IS NOT NULL").groupBy("_own_id").agg(F.min("_rank").alias("_first")).select("_first")
    others = others.join(firsts, F.col("_rank") == F.col("_first"), "left").withColumn(
        "_key", F.when(F.col("_first").isNotNull(), F.col("_own_id")).otherwise(F.col("_rank") + base))
    plain = own.join(theirs, same, "left_anti").withColumn("_key", F.col("_own_id"))
    keyed = plain.unionByName(others.select(*plain.columns)).drop("_own_id").withColumnsRenamed(
        {"doc_id": "_doc_id", "_key": "doc_id"})
    keyed = cut(keyed, "keyed")
    return stage(keyed).withColumnsRenamed({"doc_id": "_key", "_doc_id": "doc_id"}).select(*names)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier does not reject."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return by_row(docs, minhash.drop_near_duplicates)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that a document with a smaller id holds already."""
    return by_row(docs, suffixes.cut_repeats)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    return by_row(docs, lambda rows: tiling.decontaminate(rows, items))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    return bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

# Trained scores and BPE merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
