"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations make every coordinate of a signature: the first scatters the shingles over a
ring, the second is read from there with a shift that grows by one from coordinate to
coordinate. Signatures are cut into bands; texts with equal bands are candidates, and only
pairs whose full shingle sets overlap enough become links. With the default bands, a pair at the
threshold is a candidate with probability 1 - 3e-6, more similar ones more surely.

Texts with equal sets are collapsed first, so exact copies of any number cost one candidate. Then

1. the members of a band's bucket are put into overlapping classes of set size, each into two, so that
   any two sizes that can link share a class. Every member of a class is compared with the class's
   leader, the member that stands in the fullest buckets: the original that many copies were made from;
2. two members of a bucket that can link have a leader in common, whether or not they fit it, so the
   members of a leader that are still in different components meet in blocks. A block pair holds each
   text as its difference from the leader, from which the Jaccard similarity of two texts follows exactly,
   and returns a spanning forest of the links it finds. No pairs are emitted, and no group is larger than
   two blocks.

Nulls: a null text has no words; a row without an id is reported alone. Texts without words link
with nothing. Rows that repeat an id are reported each by its own text. Empty tables give no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import (
    components, cut, mix, ranges, raw_bytes, release, rolling, small_batches,
)

RING = 1 << 20
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=4)
def circulant(coordinates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and all shifted reads of the second one as rows."""
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(RING).astype(np.int32)
    second = rng.permutation(RING).astype(np.int32)
    return scatter, sliding_window_view(np.concatenate([second, second[:coordinates]]), coordinates)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``width`` are one shingle."""
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    words = ranges(rolling(data), starts, ends)
    width = min(width, len(words))
    folded = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        folded = folded * _FOLD + words[k : len(words) - width + 1 + k]
    return np.unique(mix(folded))


def signature(values: np.ndarray, coordinates: int, seed: int, block: int = 1 << 14) -> np.ndarray:
    scatter, shifted = circulant(coordinates, seed)
    places = scatter[(values & np.uint64(RING - 1)).astype(np.int64)]
    out = np.full(coordinates, RING, dtype=np.int32)
    for start in range(0, len(places), block):
        np.minimum(out, shifted[places[start : start + block]].min(axis=0), out=out)
    return out


def band_keys(sign: np.ndarray, bands: int) -> np.ndarray:
    parts = sign.astype(np.uint64).reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(parts.shape[1]):
        keys = mix(keys * _FOLD + parts[:, k])
    return keys.astype(np.int64)


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _signed(width: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            n, keys, found = [], [], []
            for text in raw_bytes(batch.column("text")):
                values = shingles(text, width)
                n.append(len(values))
                keys.append(set_key(values) if len(values) else None)
                found.append(
                    band_keys(signature(values, bands * rows, seed), bands) if len(values) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "key", "bands"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            ids, keys, values = [], [], []
            for doc_id, wanted, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(),
                raw_bytes(batch.column("text")), strict=True,
            ):
                found = shingles(text, width)
                if set_key(found) == wanted:
                    ids.append(doc_id)
                    keys.append(wanted)
                    values.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                ["doc_id", "key", "shingles"])

    return run


def _compared(percent: int):
    """Whether a pair is linked, and the difference of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "right", 2 << 20):
            linked, size, apart = [], [], []
            for left, right in zip(
                batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True
            ):
                one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                rest = np.setxor1d(one, two, assume_unique=True)
                linked.append(similar(len(rest), len(one) + len(two), percent))
                size.append(len(two))
                apart.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()),
                 pa.array(size, pa.int64()), pa.array(apart, pa.binary())],
                ["a", "b", "linked", "n", "apart"])

    return run


def similar(difference, sizes, percent: int):
    """``100 * intersection >= percent * union`` from the symmetric difference and both sizes."""
    return difference * (100 + percent) <= (100 - percent) * sizes


def size_classes(percent: int, n: str = "n"):
    """Both classes of a set size; sizes of which the smaller is ``percent`` of the larger share one."""
    ratio = max(100 / percent, 1.01) * (1 + 1e-9)  # wider than the limit, so rounding parts no pair
    own = F.floor(F.log(F.col(n)) / F.lit(math.log(ratio))).cast("int")
    return F.array(own - 1, own)


def _met(percent: int):
    """A spanning forest of the links between two blocks of one leader's members."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in rows["apart"]]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        values, at, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True)
        wanted = np.flatnonzero(counts > 1)
        number = np.full(len(values), -1)
        number[wanted] = np.arange(len(wanted))
        overlap = np.zeros((len(sets), len(sets)), np.float32)
        at = number[at]
        for start in range(0, len(wanted), 4096):
            inside = (at >= start) & (at < start + 4096)
            matrix = np.zeros((len(sets), min(4096, len(wanted) - start)), np.float32)
            matrix[owner[inside], at[inside] - start] = 1
            overlap += matrix @ matrix.T
        each = np.array([len(x) for x in sets])
        n, roots, ids = rows["n"].to_numpy(), rows["root"].to_numpy(), rows["b"].to_numpy()
        difference = each[:, None] + each[None] - 2 * overlap.astype(np.int64)
        i, j = np.nonzero(similar(difference, n[:, None] + n[None], percent)
                          & (roots[:, None] < roots[None]))
        _, first = np.unique(roots[i] * np.int64(-7046029254386353131) + roots[j], return_index=True)
        return pd.DataFrame({"x": ids[i[first]], "y": ids[j[first]]}).astype("int64")

    return run


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 24, rows: int = 4, seed: int = 7
) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``.

    Links join documents whose sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` per cent or more; ``component_id`` is the smallest id reachable over links.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(texts.mapInArrow(
        _signed(width, bands, rows, seed),
        "doc_id long, n_shingles long, key binary, bands array<long>"), "signed")
    named = signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut(named.groupBy("key").agg(F.min("doc_id").alias("id")), "classes")

    banded = named.withColumnRenamed("doc_id", "id").join(classes, ["key", "id"]).select(
        "id", F.col("n_shingles").cast("int").alias("n"), F.explode("bands").alias("band"))
    sizes = cut(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    members = cut(banded.join(sizes, "band"), "members")
    release(spark)
    fullness = cut(members.groupBy("id").agg(F.sum("size").alias("fullness")), "fullness")
    classed = members.withColumn("class", F.explode(size_classes(percent)))
    leaders = cut(classed.select("band", "class", "id").join(fullness, "id").groupBy("band", "class").agg(
        F.max(F.struct("fullness", (-F.col("id")).alias("minus"))).alias("best"))
        .select("band", "class", (-F.col("best.minus")).alias("a")), "leaders")
    pairs = cut(classed.select("band", "class", F.col("id").alias("b")).join(leaders, ["band", "class"])
                .where("a != b").select("a", "b").distinct(), "pairs")
    release(spark)

    wanted = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
                 .join(classes, "id").select(F.col("id").alias("doc_id"), "key"), "wanted")
    sets = cut(texts.join(wanted.hint("merge"), "doc_id").select("doc_id", "key", "text").mapInArrow(
        _sets(width), "doc_id long, key binary, shingles binary")
        .dropDuplicates(["doc_id", "key"]).select("doc_id", "shingles"), "sets")
    release(spark)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    compared = cut(pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(
        _compared(percent), "a long, b long, linked boolean, n long, apart binary"), "compared")
    release(spark)

    edges = compared.where("linked").select("a", "b")
    roots = cut(components(edges), "roots")
    placed = cut(compared.select("a", "b", "n", "apart").join(
        roots, F.col("b") == F.col("node"), "left").select(
        "a", "b", "n", "apart", F.coalesce("root", "b").alias("root")), "placed")
    # blocks of 64 members; larger ones in groups of thousands, to 1024
    block = F.least(F.greatest(F.col("size") / 64, F.lit(64)), F.lit(1024))
    groups = cut(placed.groupBy("a").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low != high").select("a", F.ceil(F.col("size") / block).cast("int").alias("blocks")), "groups")
    spread = placed.join(groups, "a").withColumn("own", F.expr("pmod(xxhash64(b), blocks)")).select(
        "a", "b", "n", "apart", "root", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    met = spread.groupBy("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    more = cut(met.applyInPandas(_met(percent), "x long, y long"), "more")
    release(spark)
    roots = cut(components(edges.union(more)), "roots")

    heads = cut(classes.join(roots, F.col("id") == F.col("node"), "left")
                .select("key", F.coalesce("root", "id").alias("root")), "heads")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return (signed.select("doc_id", "n_shingles", "key").join(heads, "key", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents of ``docs`` that are kept, one of each group; rows without an id stay."""
    gone = cut(near_duplicates(docs, width, percent).where("NOT kept").select(
        F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
