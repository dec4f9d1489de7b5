"""Byte-level BPE over a corpus: every distinct pre-token is encoded once, then joined back.

Documents are read in blocks of about ``BLOCK`` bytes. A block is stored as its distinct pre-tokens
and, for every position, the number of the pre-token that stands there. Only the distinct ones are
exploded and shuffled by the word: all rows of a word meet in one task, which runs BPE once for it
and gives the ids to every block that asked. Grouped by block they are the block's own list, and
reassembly by position is a lookup in it. Shuffled rows are one per block and distinct word instead of
one per position, so not even the most frequent word has more rows than there are blocks; back go
the ids of all words a task had for a block in one row. The positions are never shuffled: they are
written bucketed by block, as the lists are shuffled.

Decoding joins ids to the token-byte table. The table is the vocabulary, of fixed size, and is
broadcast; the join is a lookup by id over whole arrays.

Blocks are numbered in the task that writes them and are read back from files, so a repeated task
cannot mix two numberings. A very long text is a block of its own.

Nulls: a null text is empty and has no tokens; a null id stays null. Repeated rows give a row each.
Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import cut, release, small_batches
from remitmatch.session import scratch_path

BLOCK = 16 << 20
STEP = 1 << 18  # positions worked on at a time


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all bytes in order of ids, and where each id's bytes begin."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in table])])
    return np.frombuffer(b"".join(table), np.uint8), offsets


@lru_cache(maxsize=2)
def splitters(pattern: str) -> tuple:
    """The pattern for any text, and the same with ASCII classes for texts of ASCII only."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(
        r"\p{N}", "[0-9]").replace(r"\s", r"[\t-\r ]").replace(r"\S", r"[^\t-\r ]").replace(
        r"[^[\t-\r ]", r"[^\t-\r ")
    return regex.compile(pattern).findall, None if "\\p" in plain else re.compile(plain).findall


def pretokens(text: str, pattern: str) -> list[str]:
    full, plain = splitters(pattern)
    return plain(text) if plain and text.isascii() else full(text)


def gather(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``values[offsets[p]:offsets[p + 1]]`` one after another, and where each ends."""
    sizes = offsets[picks + 1] - offsets[picks]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(offsets[picks] - (ends - sizes), sizes)
    return values[at], ends


def _squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=9).compress(data, asbytes=True)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, small ones in one byte, compressed.

    The first bytes of all numbers come first: the number itself below 240, else 240 and the
    bits above the lower sixteen; then, for the others, the planes of their lower bytes: two, or
    four where a number is too large for that.
    """
    large = numbers >= 240
    rest = numbers[large].astype(np.int64) - 240
    planes = 4 if len(rest) and rest.max() >> 20 else 2
    first = numbers.astype(np.uint8)
    first[large] = 240 + (rest >> 16) if planes == 2 else 240
    return _squeezed(b"".join((
        len(rest).to_bytes(8, "little"), planes.to_bytes(1, "little"), first.tobytes(),
        *[(rest >> 8 * k).astype(np.uint8).tobytes() for k in range(planes)])))


def unpack(data: bytes, count: int) -> np.ndarray:
    """``count`` numbers from ``pack``."""
    raw = np.frombuffer(pa.CompressedInputStream(pa.BufferReader(data), "zstd").read(), np.uint8)
    more, planes = int.from_bytes(raw[:8].tobytes(), "little"), int(raw[8])
    numbers = raw[9 : 9 + count].astype(np.int32)
    large = numbers >= 240
    rest = (numbers[large] - 240) << 16
    for k, plane in enumerate(raw[9 + count :].reshape(planes, more)):
        rest |= plane.astype(np.int32) << 8 * k
    numbers[large] = rest + 240
    return numbers


def _blocks(pattern: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, "text", limit):
            index: dict[str, int] = {}
            codes, counts, found = [], [], []
            for value in batch.column("text"):
                found = pretokens(value.as_py() or "", pattern)
                counts.append(len(found))
                for word in set(found).difference(index):
                    index[word] = len(index)
                codes.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
            numbers = np.concatenate(codes)
            del codes
            # frequent ones first, by powers of two; in between by name, which packs well
            names = [w.encode() for w in index]
            del index, found
            order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
            level = np.log2(np.bincount(numbers, minlength=len(names))[order]).astype(np.int8)
            order = order[np.argsort(-level, kind="stable")]
            rank = np.empty(len(names), np.int32)
            rank[order] = np.arange(len(names), dtype=np.int32)
            words = pa.ListArray.from_arrays(
                pa.array([0, len(names)], pa.int32()), pa.array(names, pa.binary()).take(pa.array(order)))
            del names, order
            packed = pack(rank[numbers])
            del numbers, rank
            yield pa.RecordBatch.from_arrays(
                [pa.array([serial], pa.int64()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([counts], pa.list_(pa.int64())),
                 pa.array([packed], pa.binary()), words],
                ["block", "doc_ids", "counts", "codes", "words"])
            del packed, words
            serial += 1

    return run


def _encoded_words(path: str, pattern: str, limit: int = 1 << 20):
    """For each block the numbers of the task's words, how many ids each has, and the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path, pattern)._core_bpe.encode_single_piece
        known: dict[bytes, int] = {}
        sizes, ids, blocks, numbers, words = [], [], [], [], []

        def flush() -> pa.RecordBatch:
            block, number = np.concatenate(blocks), np.concatenate(numbers)
            order = np.lexsort((number, block))
            block, number, word = block[order], number[order], np.concatenate(words)[order]
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            values = np.array(ids, "<u4")
            begins = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            rows, total = [], []
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(block)], strict=True):
                found, ends = gather(values, offsets, word[a:b])
                each = np.diff(ends, prepend=0).astype("<u4")
                raw = b"".join(x.tobytes() for x in (
                    np.array([b - a], "<u4"), np.diff(number[a:b], prepend=0).astype("<u4"), each, found))
                total.append(len(raw))
                rows.append(pa.compress(raw, codec="zstd", asbytes=True))
            blocks.clear(), numbers.clear(), words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(block[begins], pa.int64()), pa.array(total, pa.int64()), pa.array(rows, pa.binary())],
                ["block", "size", "packed"])

        held = 0
        for batch in batches:
            picks = []
            for word in batch.column("word").to_pylist():
                at = known.get(word)
                if at is None:
                    at = known[word] = len(sizes)
                    found = encode(word)
                    sizes.append(len(found))
                    ids += found
                picks.append(at)
            blocks.append(batch.column("block").to_numpy())
            numbers.append(batch.column("number").to_numpy())
            words.append(np.array(picks, np.int64))
            held += len(picks)
            if held >= limit:
                yield flush()
                held = 0
        if held:
            yield flush()

    return run


def _dictionary(entries: list[dict] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's ids, where each entry's begin, and which entry each number has."""
    places, each, ids = [], [], []
    for entry in entries or ():
        raw = np.frombuffer(pa.decompress(entry["packed"], entry["size"], codec="zstd", asbytes=True), "<u4")
        n = int(raw[0])
        places.append(np.cumsum(raw[1 : n + 1]))
        each.append(raw[n + 1 : 2 * n + 1])
        ids.append(raw[2 * n + 1 :])
    if not places:
        return np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int32)
    numbers = np.concatenate(places)
    where = np.empty(len(numbers), np.int32)
    where[numbers] = np.arange(len(numbers), dtype=np.int32)
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(each).astype(np.int64))]), where


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids = batch.column("doc_ids")[row].values
            counts = batch.column("counts")[row].values.to_numpy()
            last = np.cumsum(counts)
            numbers = unpack(batch.column("codes")[row].as_py(), int(counts.sum()))
            values, offsets, where = _dictionary(batch.column("entries")[row].as_py())
            start = 0
            while start < len(counts):  # some documents at a time, one at least
                base = int(last[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(last, base + STEP, side="right")))
                ids, ends = gather(values, offsets, where[numbers[base : last[stop - 1]]])
                cuts = np.concatenate([[0], ends])[last[start:stop] - base].tolist()
                data = [ids[a:b].tobytes() for a, b in zip([0, *cuts], cuts, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(start, stop - start), pa.array(data, pa.binary())], ["doc_id", "ids"])
                start = stop


def encode_documents(docs: DataFrame, path: str, pattern: str, block: int = BLOCK) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text as little-endian unsigned 32-bit integers."""
    return _blocks_and_lists(docs, path, pattern, block).mapInArrow(_reassembled, "doc_id long, ids binary")


def _blocks_and_lists(docs: DataFrame, path: str, pattern: str, block: int) -> DataFrame:
    """Each block's documents, the numbers of their words, and the ids of those words."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.mapInArrow(
        _blocks(pattern, block),
        "block long, doc_ids array<long>, counts array<long>, codes binary, words array<binary>",
    ).write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).option(
        "compression", "zstd").saveAsTable(name)
    blocks = spark.table(name)
    words = blocks.select("block", F.posexplode("words").alias("number", "word"))
    entries = cut(words.repartition("word").mapInArrow(
        _encoded_words(path, pattern), "block long, size long, packed binary"), "entries")
    del words
    release(spark)
    lists = entries.groupBy("block").agg(F.collect_list(F.struct("size", "packed")).alias("entries"))
    return (
        blocks.select("block", "doc_ids", "counts", "codes").join(lists.hint("merge"), "block", "left")
        .select("doc_ids", "counts", "codes", "entries")
    )


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, offsets = token_bytes(path)
        for batch in small_batches(batches, "ids"):
            texts = [
                gather(data, offsets, np.frombuffer(ids or b"", "<u4").astype(np.int64))[0].tobytes()
                for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
                ["doc_id", "ids", "data"])

    return run


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, data``: the bytes that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path), "doc_id long, ids binary, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, block: int = BLOCK) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``; a task reassembles and decodes in one worker."""
    decode = _decoded(path)
    decoded = _blocks_and_lists(docs, path, pattern, block).mapInArrow(
        lambda batches: decode(_reassembled(batches)), "doc_id long, ids binary, data binary")
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
