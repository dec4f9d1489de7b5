"""Near duplicates among embeddings by product quantisation.

Coarse inverted lists are fitted on a bounded sample, then every vector is put in the list of its
nearest centroid with residual codes for each subspace. A vector probes every list that could hold
a partner, distances are looked up in its own tables (asymmetric), and pairs within the threshold
plus the stored quantisation error are reranked by their exact cosine in double precision.

Which lists suffice follows from the geometry. If x lies in list j and q in list i, and x and q are
at most d apart, then |q - c_j|^2 - |q - c_i|^2 <= 2 d |c_i - c_j|. ``reach`` scales that bound: at
1.0 (production) no pair can be missed, lower values probe less. The lookup keeps every pair with
asymmetric distance <= d + |x - code(x)|, which also misses none. So the sample decides speed, not
the result.

Only vectors with equal labels are compared. Equal vectors are collapsed before the index, so any
number of copies is one entry with a weight. Lists with many rows are cut into blocks, and block
meets block. A task returns weighted link counts and a spanning forest of its links instead of all
pairs.

Vectors that are null, zero or hold null or non-finite components, and rows with a null label, link
with nothing. Vectors of different length never link. A row without an id is reported alone.
Rows that repeat an id are one vector for components. Empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import components, cut

SAMPLE_ROWS = 20_000
BLOCK_ROWS = 1024


def _in_range(x: np.ndarray) -> np.ndarray:
    """``x``, times a power of two where its squares would leave the range of doubles; no cosine changes."""
    with np.errstate(over="ignore", under="ignore"):
        if 1e-280 < x @ x < 1e280:
            return x
        _, exponent = np.frexp(np.abs(x).max())
        return np.ldexp(x, -exponent) + 0.0


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for values in batch.column("embedding").to_pylist():
            vector = None
            if values and None not in values:
                x = np.asarray(values, dtype=np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    vector = _in_range(x).tobytes()
            out.append(vector)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())],
            ["vec_id", "label", "vector"])


def _units(column: pd.Series) -> np.ndarray:
    matrix = np.stack([np.frombuffer(v, np.float64) for v in column])
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds; empty ones keep their place."""
    rng = np.random.default_rng(seed)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        owner = nearest(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, points)
        counts = np.bincount(owner, minlength=len(centers))
        full = counts > 0
        centers[full] = sums[full] / counts[full, None]
    return centers


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers**2).sum(axis=1) / 2
    return np.concatenate([
        np.argmin(half - points[i : i + 4096] @ centers.T, axis=1)
        for i in range(0, len(points), 4096)
    ]) if len(points) else np.zeros(0, dtype=np.int64)


class Quantiser:
    """Coarse centroids and one codebook per slice of the residuals, for one vector length."""

    def __init__(self, sample: np.ndarray, lists: int, slices: int, codes: int, seed: int):
        self.coarse = kmeans(sample, lists, 8, seed)
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), slices) if len(p)]
        self.books = [kmeans(rest[:, p], codes, 6, seed + 1 + i) for i, p in enumerate(self.parts)]
        self.gaps = np.linalg.norm(self.coarse[:, None] - self.coarse[None], axis=2)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each row."""
        home = nearest(units, self.coarse)
        rest = units - self.coarse[home]
        codes = np.stack(
            [nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], axis=1)
        for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            rest[:, p] -= b[codes[:, i]]
        return home, codes.astype(np.uint8), np.linalg.norm(rest, axis=1)

    def probes(self, units: np.ndarray, home: np.ndarray, distance: float, reach: float) -> np.ndarray:
        """Which lists each row must visit, as a boolean matrix."""
        square = (self.coarse**2).sum(axis=1)[None] - 2 * units @ self.coarse.T
        extra = square - square[np.arange(len(units)), home][:, None]
        return extra <= 2 * distance * reach * self.gaps[home] + 1e-9

    def lookup(self, units: np.ndarray, list_id: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of query rows to the coded rows of one list."""
        rest = units - self.coarse[list_id]
        total = np.zeros((len(units), len(codes)))
        for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            tables = ((rest[:, p][:, None] - b[None]) ** 2).sum(axis=2)
            total += tables[:, codes[:, i]]
        return np.sqrt(total)


def _indexed(quantisers, distance: float, reach: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for dim, frame in whole.groupby(whole["vector"].str.len() // 8):
                q = quantisers.value[dim]
                for start in range(0, len(frame), 2048):
                    part = frame.iloc[start : start + 2048]
                    units = _units(part["vector"])
                    home, codes, error = q.encode(units)
                    visits = q.probes(units, home, distance, reach)
                    yield pd.DataFrame({
                        "label": part["label"].to_numpy(), "dim": dim, "list": home,
                        "head": part["head"].to_numpy(), "weight": part["weight"].to_numpy(),
                        "vector": part["vector"].to_numpy(), "error": error,
                        "codes": [c.tobytes() for c in codes],
                        "visits": [np.flatnonzero(v).tolist() for v in visits]})

    return run


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    a, b = [], []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        r, s = find(x), find(y)
        if r != s:
            parent[max(r, s)] = min(r, s)
            a.append(x)
            b.append(y)
    return a, b


def _linked(quantisers, cosine: float, distance: float):
    def run(key: tuple, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        if queries.empty or entries.empty:
            return empty
        q, list_id = quantisers.value[int(key[1])], int(key[2])
        codes = np.stack([np.frombuffer(c, np.uint8) for c in entries["codes"]])
        error = entries["error"].to_numpy()
        raw = np.stack([np.frombuffer(v, np.float64) for v in entries["vector"]])
        ids, weight = entries["head"].to_numpy(), entries["weight"].to_numpy()
        norms = np.linalg.norm(raw, axis=1)
        counts: dict[int, int] = {}
        left, right = [], []
        for start in range(0, len(queries), 256):
            part = queries.iloc[start : start + 256]
            own, own_weight = part["head"].to_numpy(), part["weight"].to_numpy()
            vectors = np.stack([np.frombuffer(v, np.float64) for v in part["vector"]])
            length = np.linalg.norm(vectors, axis=1)
            near = q.lookup(vectors / length[:, None], list_id, codes) <= distance + error[None] + 1e-9
            i, j = np.nonzero(near & (own[:, None] < ids[None]))
            for s in range(0, len(i), 1 << 16):
                x, y = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                exact = np.einsum("ij,ij->i", vectors[x], raw[y]) / (length[x] * norms[y])
                x, y = x[exact >= cosine], y[exact >= cosine]
                for who, what in ((own[x], weight[y]), (ids[y], own_weight[x])):
                    who, at = np.unique(who, return_inverse=True)
                    sums = np.bincount(at, weights=what, minlength=len(who)).astype(np.int64)
                    for k, v in zip(who.tolist(), sums.tolist(), strict=True):
                        counts[k] = counts.get(k, 0) + v
                a, b = _forest(own[x], ids[y])
                left += a
                right += b
        a, b = _forest(np.array(left, np.int64), np.array(right, np.int64))
        return pd.DataFrame({
            "a": [*counts, *a], "b": [*counts, *b], "links": [*counts.values(), *[0] * len(a)],
        }).astype("int64")

    return run


def near_duplicates(
    embeddings: DataFrame, cosine: float = 0.98, reach: float = 1.0, slices: int = 8,
    codes: int = 64, list_rows: int = 512, most_lists: int = 4096, sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS, seed: int = 11,
) -> DataFrame:
    """Per vector ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other vectors with the same label and a cosine of at least ``cosine``;
    ``component_id`` is the smallest id reachable over links. Centroids and codebooks are fitted
    on ``sample_rows`` distinct vectors at most, taken by a hash of their ids; about one list
    for ``list_rows`` vectors of the largest label, ``most_lists`` at most.
    """
    if codes > 256:
        raise ValueError("a code is one byte: 256 codes at most")
    spark = embeddings.sparkSession
    distance = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = cut(embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        "embedding").mapInArrow(_checked, "vec_id long, label string, vector binary"), "vectors")
    classes = cut(rows.where("label IS NOT NULL AND vector IS NOT NULL").groupBy("label", "vector").agg(
        F.min("vec_id").alias("head"), F.count(F.lit(1)).alias("weight")), "classes")
    named = classes.where("head IS NOT NULL")

    dims = [r["dim"] for r in named.select((F.length("vector") / 8).cast("int").alias("dim")).distinct().collect()]
    fitted = {}
    for dim in dims:
        own = named.where(F.length("vector") == dim * 8)
        # only rows of one label meet in a list, so the largest label sets the number of lists
        total = own.groupBy("label").count().agg(F.max("count")).first()[0]
        sample = own.orderBy(F.xxhash64("head", F.lit(seed)), "head", "vector").select("vector").limit(sample_rows).toPandas()
        lists = int(min(most_lists, max(1, total // list_rows), len(sample)))
        fitted[dim] = Quantiser(_units(sample["vector"]), lists, slices, codes, seed)
    quantisers = spark.sparkContext.broadcast(fitted)

    index = cut(named.mapInPandas(
        _indexed(quantisers, distance, reach),
        "label string, dim int, list int, head long, weight long, vector binary, error double, "
        "codes binary, visits array<int>"), "index")
    place = ["label", "dim", "list"]
    cells = index.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("entry_blocks"))
    asked = index.select("label", "dim", F.explode("visits").alias("list"), "head", "weight", "vector")
    visits = asked.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("query_blocks"))
    cells = cut(cells.join(visits, place), "cells")
    salt = lambda n: F.pmod(F.xxhash64("head", "vector"), F.col(n)).cast("int")
    entries = index.join(cells, place).select(
        *place, "head", "weight", "vector", "error", "codes", salt("entry_blocks").alias("x"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("y"))
    queries = asked.join(cells, place).select(
        *place, "head", "weight", "vector", salt("query_blocks").alias("y"),
        F.explode(F.sequence(F.lit(0), F.col("entry_blocks") - 1)).alias("x"))
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # apart from the entries' columns
    key = [*place, "x", "y"]
    found = cut(queries.groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(
        _linked(quantisers, cosine, distance), "a long, b long, links long"), "found")

    counts = found.where("a = b").groupBy(F.col("a").alias("head")).agg(F.sum("links").alias("links"))
    roots = components(found.where("a != b").select("a", "b"))
    known = cut(classes.join(counts, "head", "left").join(
        roots, F.col("head") == F.col("node"), "left").select(
        "label", "vector", "weight", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "head").alias("root")), "known")
    linked = F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "vec_id"))
    return (
        rows.join(known, ["label", "vector"], "left")
        .select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0)))
                .cast("long").alias("n_links"), linked.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
