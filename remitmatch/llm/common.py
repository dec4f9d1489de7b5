"""Helpers shared by the training-data operators: tables, the shared folder, hashing, components."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitmatch.session import scratch_path

_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete tables written by ``cut`` that nothing will read again."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files nobody refers to any more, after a step was written.

    Twice: what the first round frees on either side still held something on the other.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def give_back() -> None:
    """Return what a task has freed to the system: its worker process stays and would hold it in later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20):
    """Arrow batches cut so that one holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a splittable generator)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=2)
def letters(table: int = 0) -> np.ndarray:
    """A random 64-bit number for each byte; another table gives an independent hash."""
    return mix(np.arange(1 + 256 * table, 257 + 256 * table, dtype=np.uint64) * np.uint64(_STEP))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 17, 1 << int(n - 1).bit_length())
        for key, step in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            factors = np.full(size, step, dtype=np.uint64)
            factors[0] = 1
            _POWERS[key] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def rolling(data: np.ndarray, table: int = 0) -> np.ndarray:
    """Prefix sums of a polynomial hash over bytes, one longer than the data."""
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(letters(table)[data] * up[: len(data)], out=sums[1:])
    return sums


def grams(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ranges of ``size`` bytes, as ``ranges`` gives them."""
    n = len(sums) - size
    return mix((sums[size:] - sums[:n]) * _powers(len(sums))[1][:n] + np.uint64(size * _STEP % (1 << 64)))


def ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they stand."""
    _, down = _powers(len(sums))
    length = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + length * np.uint64(_STEP))


def fingerprint(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")).first()
    return row["n"], row["x"] or 0


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each linked id can reach: columns ``node``, ``root``.

    ``edges`` has two BIGINT columns. Large-star and small-star rounds: every id hangs its
    larger neighbours, then its smaller ones, on the smallest id it knows, until nothing
    changes. A round is two aggregations and two joins; minima are combined before the
    shuffle and read back from files, so that a hub's rows can be split in the join.
    """
    a, b = edges.columns
    current = cut(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges"
    )
    seen = fingerprint(current)
    while seen[0]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")), "low")
        large = cut(both.where("v > u").join(low, "u")
                    .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        current = cut(
            large.join(least, "a").where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct(), "edges"
        )
        now = fingerprint(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
