"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into 2**bits cells. The cell boundaries are quantiles over all rows, so
cells hold about equal numbers of rows: a mergeable sketch for numbers and dates; for strings, whole values
at which the running total of their counts passes a share of the rows. A row's cells give its place on the curve; rows sorted by it are
cut into runs of equal length. Neighbours on the curve are neighbours in every dimension, so a
shard covers a small box and files can be pruned by the minima and maxima of any dimension.

The law is ``rows``: shard counts differ by one at most. Ranks come from a range-partitioned sort:
each partition numbers its own rows, and prefix sums over the partitions' counts add the offset; no
task sees all rows. Rows on one point of the curve are ordered by further columns, so a
point that holds a third of all rows is spread over partitions too.

Only identifiers, metadata, size and checksum are shuffled to find the ranks. Nulls: a null text has
size 1 (0 bytes plus 1) and checksum 0; null metadata sorts into cell 0; rows without an id or with a
repeated id get a slot each. Empty tables give no rows; other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitmatch.llm.common import cut

SHARDS = 16
BITS = 5


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (rows, dimensions).

    The cells' bits are turned, plane by plane from the top, by the reflection and exchange of axes
    that the planes above demand, then read as a Gray code.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for i in range(n):
            high = (x[i] & plane) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        plane >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        turn = np.where((x[n - 1] & plane) > 0, turn ^ (plane - 1), turn)
        plane >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> bit & 1)
    return index


def ordinal(docs: DataFrame, name: str) -> Column:
    """A number that keeps the column's order; strings as they are."""
    kind = docs.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return column.cast("timestamp").cast("double")
    return column.cast("double")


def string_bounds(docs: DataFrame, name: str, shares: Sequence[float]) -> list[str]:
    """For each share, the smallest value that so many rows do not exceed.

    Values are counted, then range-partitioned; the partitions' sums are added on the driver, and
    only the values at the bounds are collected.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = docs.select(F.col(name).alias("value")).where("value IS NOT NULL").groupBy("value").count()
    placed = cut(values.repartitionByRange(parts, "value").withColumn("_part", F.spark_partition_id()), "values")
    sums = sorted(tuple(r) for r in placed.groupBy("_part").agg(F.sum("count")).collect())
    bases = [0, *accumulate(n for _, n in sums)]
    if not bases[-1]:
        return []
    offsets = spark.createDataFrame(
        [(p, b) for (p, _), b in zip(sums, bases, strict=False)], "_part int, _base long")
    own = Window.partitionBy("_part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.withColumn("_own", F.sum("count").over(own)).join(F.broadcast(offsets), "_part").select(
        "value", (F.col("_base") + F.col("_own")).alias("upto"), "count")
    wanted = F.array(*[F.lit(math.ceil(share * bases[-1])) for share in shares])
    at = F.exists(wanted, lambda w: (w <= F.col("upto")) & (w > F.col("upto") - F.col("count")))
    return sorted((r["value"] for r in upto.where(at).select("value").collect()), key=lambda v: v.encode("utf-8"))


def _below(edges: Column, column: Column) -> Column:
    """How many edges are smaller than the column."""
    return F.size(F.filter(edges, lambda edge: edge < column))


def with_curve(docs: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> DataFrame:
    """``docs`` with the cells ``_d0, _d1, ...`` and the place ``_curve`` on the curve."""
    if not dimensions or bits * len(dimensions) > 62:
        raise ValueError("one dimension at least, 62 bits at most")
    shares = [k / 2**bits for k in range(1, 2**bits)]
    numbers = {f"_d{i}": ordinal(docs, name) for i, name in enumerate(dimensions)}
    words = {f"_d{i}": name for i, name in enumerate(dimensions)
             if isinstance(docs.schema[name].dataType, T.StringType)}
    plain = {key: column for key, column in numbers.items() if key not in words}
    bounds = docs.select(*[c.alias(k) for k, c in plain.items()]).agg(
        *[F.percentile_approx(k, shares, 10_000).alias(k) for k in plain]).first() if plain else {}
    cells = {}
    for key, column in numbers.items():
        if key in words:
            cuts = string_bounds(docs, words[key], shares)
        else:
            cuts = [float(c) for c in sorted(set(bounds[key] or []))]
        kind = "array<string>" if key in words else "array<double>"
        edges = F.array(*map(F.lit, cuts)) if cuts else F.array().cast(kind)
        cells[key] = F.when(column.isNull(), 0).otherwise(_below(edges, column)).cast("int")

    @F.pandas_udf("long")
    def curve(*parts: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack([p.to_numpy() for p in parts]), bits))

    return docs.withColumns(cells).withColumn("_curve", curve(*cells))


def ranked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``_rank`` from 0 in the order of ``keys``, and ``_total``; written on the way."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranked")
    counts = sorted(tuple(r) for r in placed.groupBy("_part").count().collect())
    bases = [0, *accumulate(n for _, n in counts)]
    offsets = spark.createDataFrame(
        [(p, b) for (p, _), b in zip(counts, bases, strict=False)], "_part int, _base long")
    return placed.join(F.broadcast(offsets), "_part").select(
        *rows.columns, (F.col("_base") + F.col("_row")).alias("_rank"), F.lit(bases[-1]).cast("long").alias("_total"))


def hilbert_shards(docs: DataFrame, dimensions: Sequence[str] = ("lang", "source", "n_chars"),
                   shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per document its size, checksum, place on the curve, shard and slot in the shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_curve(docs, dimensions, bits).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.col("_curve").alias("curve"))
    rank = ranked(rows, ["curve", "doc_id", "text_crc32", "size"])
    return (
        rank.withColumn("shard", F.expr(f"(_rank * {shards}) div _total"))
        # the first rank of a shard is the smallest r with r * shards div total = shard
        .withColumn("slot", F.expr(f"_rank - (shard * _total + {shards - 1}) div {shards}"))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"), "curve")
    )


def write_shards(docs: DataFrame, path: str, dimensions: Sequence[str] = ("lang", "source", "n_chars"),
                 shards: int = SHARDS, bits: int = BITS) -> None:
    """Write whole rows under ``path/shard=N``, each shard sorted along the curve.

    All rows of a shard are written by several tasks (one range of slots each), so a shard may be
    larger than a task's memory.
    """
    names = docs.columns
    tie = F.xxhash64(*[F.col(c).cast("string") for c in names])
    rows = with_curve(docs, dimensions, bits).withColumn("_tie", tie)
    rank = ranked(rows.select(*names, "_curve", "_tie"), ["_curve", "_tie"])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rank.withColumn("shard", F.expr(f"int((_rank * {shards}) div _total)"))
     .repartitionByRange(parts, "_rank").sortWithinPartitions("_rank")
     .select(*names, "shard").write.partitionBy("shard").parquet(path))
