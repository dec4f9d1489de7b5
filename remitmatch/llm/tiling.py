"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and non-ASCII bytes, A-Z lowered, compared by 64-bit hashes. Runs of
``shortest`` words (seeds) of the test items are matched with those of all documents. A
document with a seed keeps its words around the seeds, as far as an item could reach; the pairs of
document and item that share a seed then go through tiling: the longest common runs of unmarked
words are searched with running Karp-Rabin hashes, marked without overlap, and the search goes on with
shorter runs down to ``shortest``. Tiles may stand in any order, so passages that were
rearranged count too. A pair is contaminated if tiles cover ``coverage`` of the item's words, or if one
tile has ``long_tile`` words or more: a long passage is a leak however long its item is.

The item seeds are looked up inside the scan if they are few (``broadcast_seeds``, 8 bytes each);
beyond that they meet the documents' seeds in a shuffled join, with the same result.

Items of fewer than ``shortest`` words carry no evidence and match nothing. Null texts are empty;
rows without an id, document or item, are left out. Documents that repeat an id are tiled each, the
best coverage counts. Items that repeat an id with another text are separate texts of one item. Empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import cut, mix, ranges, raw_bytes, rolling, small_batches

BROADCAST_SEEDS = 4_000_000
_BASE = 0xD6E8FEB86659FD93
_FACTOR = np.uint64(_BASE)
_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
_WORD[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = True


def word_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text.lower(), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    edges = np.flatnonzero(np.diff(inside))
    return ranges(rolling(data), edges[::2], edges[1::2]) if len(edges) else np.zeros(0, np.uint64)


def seeds(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    folded = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        folded = folded * _FACTOR + words[k : len(words) - width + 1 + k]
    return mix(folded)


def _runs(words: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Start and rolling hash of each unmarked run of ``size`` words."""
    top, mask = pow(_BASE, size, 1 << 64), (1 << 64) - 1
    value = length = 0
    for i, word in enumerate(words):
        if marked[i]:
            value = length = 0
            continue
        value = (value * _BASE + word) & mask
        length += 1
        if length > size:
            value = (value - words[i - size] * top) & mask
        if length >= size:
            yield i - size + 1, value


def _matches(item, taken, text, used, size: int) -> list[tuple[int, int]]:
    """Places in item and text where equal unmarked runs of ``size`` words begin."""
    places: dict[int, list[int]] = {}
    for start, value in _runs(item, taken, size):
        places.setdefault(value, []).append(start)
    return sorted(
        (a, b) for b, value in (_runs(text, used, size) if places else ())
        for a in places.get(value, ()) if item[a : a + size] == text[b : b + size])


def tile(item: list[int], text: list[int | None], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(place in item, place in text, words)``, longest first, without overlap.

    A common run of some length holds common runs of every shorter one, so the longest length is
    found by halving; all its runs are marked, then the next length is searched.
    """
    taken, used = [False] * len(item), [w is None for w in text]
    tiles = []
    limit = len(item)
    while limit >= shortest:
        low, best, found = shortest, 0, []
        while low <= limit:
            size = (low + limit) // 2
            if pairs := _matches(item, taken, text, used, size):
                best, found, low = size, pairs, size + 1
            else:
                limit = size - 1
        for a, b in found:
            if not any(taken[a : a + best]) and not any(used[b : b + best]):
                taken[a : a + best] = used[b : b + best] = [True] * best
                tiles.append((a, b, best))
        limit = best
        if not best:
            break
        limit = best - 1 if not _matches(item, taken, text, used, best) else best
    return tiles


def _segments(width: int, wanted):
    """Documents that hold a wanted seed: the words near seeds, with gaps, and the seeds' hashes.

    ``wanted`` holds the seeds in order and for each how long the longest item is that has it: no tile
    around the seed reaches further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            ids, words, hits = [], [], []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), raw_bytes(batch.column("text")), strict=True
            ):
                own = word_hashes(text)
                found = seeds(own, width)
                known, longest = wanted.value
                at = np.searchsorted(known, found)
                at[at == len(known)] = 0
                places = np.flatnonzero(known[at] == found)
                if not len(places):
                    continue
                reach = longest[at[places]]
                near = np.zeros(len(own) + 1, np.int64)
                np.add.at(near, np.maximum(places - reach, 0), 1)
                np.add.at(near, np.minimum(places + width + reach, len(own)), -1)
                keep = np.cumsum(near[:-1]) > 0
                spots = np.flatnonzero(keep)
                gaps = np.flatnonzero(np.diff(spots) > 1) + 1
                parts = np.split(own[spots].astype(np.int64), gaps)
                line: list[int | None] = []
                for part in parts:
                    line += [None] * bool(line) + part.tolist()
                ids.append(doc_id)
                words.append(line)
                hits.append(np.unique(found[places]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.int64())),
                 pa.array(hits, pa.list_(pa.int64()))], ["doc_id", "words", "hits"])

    return run


def _all_seeds(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            found = [np.unique(seeds(word_hashes(t), width)) for t in raw_bytes(batch.column("text"))]
            owners = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners)),
                 pa.array(np.concatenate(found).astype(np.int64))], ["doc_id", "seed"])

    return run


def _items(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = [word_hashes(t) for t in raw_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"),
                 pa.array([w.astype(np.int64) for w in words], pa.list_(pa.int64())),
                 pa.array([np.unique(seeds(w, width)).astype(np.int64) for w in words],
                          pa.list_(pa.int64()))], ["item_id", "item", "seeds"])

    return run


def _tiled(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, count, longest = [], [], []
            for item, text in zip(
                batch.column("item").to_pylist(), batch.column("words").to_pylist(), strict=True
            ):
                unsigned = [w % (1 << 64) for w in item]
                tiles = tile(unsigned, [None if w is None else w % (1 << 64) for w in text], shortest)
                covered.append(sum(t[2] for t in tiles))
                count.append(len(tiles))
                longest.append(max((t[2] for t in tiles), default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), batch.column("n_words"),
                 pa.array(covered, pa.int64()), pa.array(count, pa.int64()), pa.array(longest, pa.int64())],
                ["doc_id", "item_id", "n_words", "n_covered", "n_tiles", "longest"])

    return run


def contaminated_pairs(docs: DataFrame, items: DataFrame, shortest: int = 5, coverage: float = 0.6,
                       broadcast_seeds: int = BROADCAST_SEEDS, long_tile: int = 50) -> DataFrame:
    """Contaminated pairs ``doc_id, item_id, n_words, n_covered, n_tiles, coverage``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    known = cut(
        items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
        .mapInArrow(_items(shortest), "item_id long, item array<long>, seeds array<long>")
        .where("size(seeds) > 0").distinct(), "items")
    marks = cut(known.select(F.explode("seeds").alias("seed"), F.size("item").alias("n")).groupBy("seed").agg(
        F.max("n").cast("long").alias("reach")), "seeds")
    total = marks.count()
    if total > broadcast_seeds:
        holders = cut(texts.mapInArrow(_all_seeds(shortest), "doc_id long, seed long")
                      .join(marks, "seed").groupBy("doc_id").agg(
                          F.sort_array(F.collect_set(F.struct("seed", "reach"))).alias("own")), "holders")
        near = texts.join(holders, "doc_id").mapInArrow(
            _near(shortest), "doc_id long, words array<long>, hits array<long>")
    else:
        wanted = spark.sparkContext.broadcast(_in_order(*(c.to_numpy() for c in marks.toArrow().columns)))
        near = _none(texts) if not total else texts.mapInArrow(
            _segments(shortest, wanted), "doc_id long, words array<long>, hits array<long>")
    near = cut(near, "near")
    owners = known.select(F.explode("seeds").alias("seed"), "item_id", F.xxhash64("item").alias("version"))
    row = F.xxhash64("words").alias("row")
    pairs = (
        near.select("doc_id", row, F.explode("hits").alias("seed")).join(owners, "seed")
        .select("doc_id", "row", "item_id", "version").distinct()
    )
    versions = known.select("item_id", F.xxhash64("item").alias("version"), "item")
    joined = cut(pairs, "pairs").join(versions, ["item_id", "version"]).join(
        near.select("doc_id", row, "words"), ["doc_id", "row"])
    tiled = joined.select(
        "doc_id", "item_id", F.size("item").cast("long").alias("n_words"), "item", "words").mapInArrow(
        _tiled(shortest), "doc_id long, item_id long, n_words long, n_covered long, n_tiles long, longest long")
    share = F.col("n_covered") / F.col("n_words")
    return (
        tiled.withColumn("coverage", share).where((F.col("coverage") >= coverage) | (F.col("longest") >= long_tile))
        .groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_words", "n_covered", "n_tiles")).alias("best"))
        .select("doc_id", "item_id", "best.n_words", "best.n_covered", "best.n_tiles", "best.coverage")
    )


def _in_order(found: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds as unsigned numbers in order, and the reach of each."""
    found = found.astype(np.uint64)
    order = np.argsort(found)
    return found[order], reach[order]


def _near(width: int):
    """As ``_segments``, with each document's own seeds beside it."""

    class Held:
        def __init__(self, value):
            self.value = value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                own = one.column("own")[0].as_py()
                own = _in_order(*(np.array([o[c] for o in own], np.int64) for c in ("seed", "reach")))
                yield from _segments(width, Held(own))(iter([one]))

    return run


def _none(texts: DataFrame) -> DataFrame:
    return texts.limit(0).select(
        "doc_id", F.array().cast("array<long>").alias("words"), F.array().cast("array<long>").alias("hits"))


def decontaminate(docs: DataFrame, items: DataFrame, shortest: int = 5, coverage: float = 0.6) -> DataFrame:
    """The documents of ``docs`` without contaminated ones; rows without an id stay."""
    bad = cut(contaminated_pairs(docs, items, shortest, coverage).select(
        F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").cast("long") == F.col("_bad"), "left_anti")
