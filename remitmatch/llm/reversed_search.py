"""Ranked lexical search turned round: documents are streamed past an inverted index of the items.

Items are the queries and documents the collection. The items of a block, bounded by ``postings``, become
an inverted index (term to items), which is broadcast. One pass over the documents counts the terms of each whole
text and keeps what the index knows: the numbers of the terms and how often they occur, with the length of
the document. That small table is written; document frequencies and the collection's size come from it. A
second pass streams it past the index: a document's terms add their part to the scores of their items, and
a heap of ``top`` places for each item keeps the best documents of the task. The heaps of all tasks are
merged by ranking their rows. No document meets an item without a common term, no term is shuffled, and a
term that stands in every document is one entry of the index like any other.

A term's weight is ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` in doubles; all other steps are whole
numbers. A term of an item counts as often as it occurs there.

Blocks: the distinct texts of the items are dealt by hash into as many blocks as their terms need at ``postings``
each; each block is one pass over the documents. A text is never split, so the largest one decides how far a
block may go beyond.

Nulls: a null text has no terms and is found by nothing; an item without terms finds nothing. A null
document id comes after all others among equal scores, a null item id is an id like any other. Ties go to the smaller id.
Rows that repeat a document id are ranked each; rows that repeat an item id give a list each, and rows that
repeat a text are searched once. A text of any length is one task's work on its own; its terms are counted whole. Empty tables give
no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitmatch.llm.common import cut, raw_bytes, small_batches

# Fixed by the operator's contract: what a term is, and the constants of the score.
TERM_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
SCALE, SATURATION, LENGTH_SHARE, WEIGHT_SCALE = 1_000_000_000, 12, 25, 1000

POSTINGS = 1 << 19  # terms of items in a block
CELLS = 1 << 22  # scores (documents times items) held at a time

_LOWERED = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c) if c in TERM_BYTES else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased."""
    return text.translate(_LOWERED).split()


class Index:
    """The inverted index of a block of items: term numbers, and for each the items that hold it."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.numbers: dict[bytes, int] = {}
        rows: list[tuple[int, int, int]] = []
        for place, text in enumerate(texts):
            for term, times in Counter(terms(text.encode())).items():
                rows.append((self.numbers.setdefault(term, len(self.numbers)), place, times))
        rows.sort()
        found = np.array(rows, np.int64).reshape(-1, 3)
        self.items, self.times = found[:, 1].astype(np.int32), found[:, 2]
        self.offsets = np.concatenate(
            [[0], np.cumsum(np.bincount(found[:, 0], minlength=len(self.numbers)))]).astype(np.int64)

    def postings(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all given terms one after another: the row of each posting, and its place in the lists."""
        sizes = self.offsets[numbers + 1] - self.offsets[numbers]
        rows = np.repeat(np.arange(len(numbers)), sizes)
        ends = np.cumsum(sizes)
        return rows, np.arange(len(rows)) + np.repeat(self.offsets[numbers] - (ends - sizes), sizes)


def _counted(index):
    """``doc_id, n, numbers, times`` of each document with a term: its length and the terms that the index knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.numbers
        for batch in small_batches(batches, "text", 4 << 20):
            picks, lengths, numbers, times, ends = [], [], [], [], [0]
            for row, text in enumerate(raw_bytes(batch.column("text"))):
                found = terms(text)
                if not found:
                    continue
                counts = Counter(found)
                held = counts.keys() & known.keys()
                picks.append(row)
                lengths.append(len(found))
                numbers += map(known.__getitem__, held)
                times += map(counts.__getitem__, held)
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(picks, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                ["doc_id", "n", "numbers", "times"])

    return run


def _place(doc_id: int | None) -> int:
    """A number that is larger for an id that comes first among equal scores."""
    return -(1 << 64) if doc_id is None else -doc_id


def _searched(index, weights, documents: int, words: int, top: int):
    """``item, doc_id, score`` of the best ``top`` documents that a task has for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = index.value, weights.value
        n_items = len(block.texts)
        step = max(1, CELLS // max(1, n_items))
        heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        least = np.ones(n_items, np.int64)  # the lowest score that still enters
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ends = batch.column("numbers").offsets.to_numpy().astype(np.int64)
                numbers = batch.column("numbers").values.to_numpy()[ends[0] : ends[-1]]
                times = batch.column("times").values.to_numpy()[ends[0] : ends[-1]]
                own = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                share = np.array([  # Python's integers: the product may exceed 64 bits
                    SATURATION * (100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // words)
                    for n in batch.column("n").to_pylist()], np.int64)
                part = weight[numbers] * (SCALE * times // (1000 * times + share[own]))
                rows, places = block.postings(numbers)
                scores = np.zeros(batch.num_rows * n_items, np.int64)
                np.add.at(scores, own[rows] * n_items + block.items[places], part[rows] * block.times[places])
                scores = scores.reshape(batch.num_rows, n_items)
                bar = least
                if batch.num_rows > top:  # what cannot be among the best of this batch stays out
                    bar = np.maximum(least, np.partition(scores, -top, axis=0)[-top])
                docs, hits = np.nonzero(scores >= bar)
                ids = batch.column("doc_id").to_pylist()
                for d, i, score in zip(docs.tolist(), hits.tolist(), scores[docs, hits].tolist(), strict=True):
                    heap, entry = heaps[i], (score, _place(ids[d]))
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[i] = heap[0][0]
        found = [(i, p, s) for i, heap in enumerate(heaps) for s, p in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _, _ in found], pa.int32()),
             pa.array([None if p == -(1 << 64) else -p for _, p, _ in found], pa.int64()),
             pa.array([s for _, _, s in found], pa.int64())], ["item", "doc_id", "score"])

    return run


def _search_block(documents: DataFrame, texts: list[str], top: int) -> DataFrame:
    spark = documents.sparkSession
    index = spark.sparkContext.broadcast(Index(texts))
    counted = cut(documents.mapInArrow(
        _counted(index), "doc_id long, n long, numbers array<int>, times array<long>"), "counted")
    total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    n, words = total["docs"], total["words"] or 1
    held = np.zeros(len(index.value.numbers), np.int64)
    for row in counted.select(F.explode("numbers").alias("number")).groupBy("number").count().collect():
        held[row["number"]] = row["count"]
    weight = np.array([math.floor(WEIGHT_SCALE * math.log((2 * n + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
    weights = spark.sparkContext.broadcast(weight)
    best = cut(counted.where(F.size("numbers") > 0).mapInArrow(
        _searched(index, weights, n, words, top), "item int, doc_id long, score long"), "heaps")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    asked = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    return ranked.join(F.broadcast(asked), "item").select("text", "rank", "doc_id", "score")


def ranked_search(documents: DataFrame, items: DataFrame, top: int = 20, postings: int = POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``top`` documents of each item with a score above 0."""
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    texts = asked.select("text").distinct()  # rows that repeat a text are searched once
    # at most one term for each two bytes, so the blocks are sized before anything is read whole
    bound = texts.agg(F.sum((F.octet_length("text") + 1) / 2).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(bound / postings))
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    found = [_search_block(read, sorted(r["text"] for r in texts.where(block == k).collect()), top)
             for k in range(blocks)]
    return asked.join(reduce(DataFrame.unionByName, found), "text").select("item_id", "rank", "doc_id", "score")
