"""Token ids as flat binary files with 64-bit document offsets, written and memory-mapped by Spark.

Documents are range-partitioned and sorted by id. Each task writes a pair of files:

* ``*.bin``: the ids of its documents one after another, unsigned, 16 bits wide where the
  vocabulary allows, else 32;
* ``*.idx``: the number of documents n, then n + 1 offsets into the ids, n document ids and n flags
  for null ids, all as 64-bit integers (little-endian).

A manifest, one row per pair, is written through Spark, so only files of tasks that succeeded are
listed; files of lost attempts have names of their own and are never read. Prefix sums over the
manifest's counts give each pair the place of its first id in the whole. Readers map a pair into
memory and need no other file. The folder must be one that all executors reach.

Nulls: a null text is empty and has the end id alone; rows without an id come first. Rows that
repeat an id are kept each, ordered by text, and are parted by their first ``PARTED`` characters. Empty tables write no files and give no rows; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.bpe import pretokens
from remitmatch.llm.common import cut, small_batches
from remitmatch.session import scratch_path

_SPACE, _TAB = re.compile(r"\s"), re.compile(r"[^\S\n ]")
_LOOSE = ("  ", " \n", "\n\n")  # white space that belongs to no word and no single line break
PARTED = 64
MANIFEST = "part long, name string, docs long, ids long, width int"


def storage(folder: str) -> tuple[pfs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pfs.FileSystem.from_uri(folder)
    return pfs.LocalFileSystem(), folder


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


class Encoder:
    """The ids of texts; each word is given to the library once while it is remembered.

    A text is cut before every space that a word follows and before line breaks, where no pre-token can cross:
    what comes after is encoded as in the whole text. Texts with more white space in one place are cut by the pattern itself. Texts
    that hold an added token's string (``<|endoftext|>``) are given to the library whole, which finds the token
    there by its own rules. New words go to the library many at a time, one after another; as each begins with
    its only space, the tokens that begin with a space tell them apart.
    """

    def __init__(self, path: str, pattern: str, remembered: int = 1 << 20):
        self.tokenizer, self.pattern, self.remembered = tokenizer(path), pattern, remembered
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0][0]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(space)]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain: dict[str, bytes] = {}  # the ids of words as they are
        self.spaced: dict[str, bytes] = {}  # and of words with a space before them

    def holds_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def learn(self, words: set[str]) -> None:
        """Add the ids of a space and each word; a word that begins with a line break follows no space."""
        whole = [w for w in words if w and not _SPACE.search(w)]
        other = list(words.difference(whole))
        for at in range(0, len(whole), 1024):
            group = whole[at : at + 1024]
            text = " " + " ".join(group)
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")
            starts = np.flatnonzero(self.opens[found])
            if self.holds_added(text) or len(starts) != len(group):
                other += group
                continue
            data, cuts = found.tobytes(), (4 * np.append(starts, len(found))).tolist()
            self.spaced.update(zip(group, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        self.spaced.update(zip(other, self.each([w if w[:1] == "\n" else " " + w for w in other]), strict=True))

    def each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<i4").tobytes()
                for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text ends."""
        if len(self.plain) + len(self.spaced) > self.remembered:
            self.plain, self.spaced = {}, {}
        split: list[tuple[str, list[str]]] = []
        heads: set[str] = set()
        tails: set[str] = set()
        for text in texts:
            if self.holds_added(text):
                split.append(("whole", [text]))
            elif any(s in text for s in _LOOSE) or _TAB.search(text):
                split.append(("loose", pretokens(text, self.pattern)))
                heads.update(split[-1][1])
            else:
                split.append(("tight", text.replace("\n", " \n").split(" ")))
                heads.add(split[-1][1][0])
                tails.update(split[-1][1][1:])
        if new := list(heads.difference(self.plain)):
            self.plain.update(zip(new, self.each(new), strict=True))
        if new := tails.difference(self.spaced):
            self.learn(new)
        plain, spaced = self.plain.__getitem__, self.spaced.__getitem__
        found = []
        for kind, parts in split:
            if kind == "whole":
                found += self.each(parts)
            elif kind == "loose":
                found.append(b"".join(map(plain, parts)))
            else:
                head = plain(parts[0])
                found.append(head + b"".join(map(spaced, parts[1:])) if len(parts) > 1 else head)
        ends = np.cumsum([len(f) // 4 for f in found]).astype(np.int64)
        return np.frombuffer(b"".join(found), "<i4"), ends


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path, pattern)


def _written(folder: str, path: str, pattern: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        width = 2 if max(own.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        files, root = storage(folder)
        sizes, names = [], []
        sink = None
        for batch in small_batches(batches, "text", 1 << 20):
            if sink is None:
                files.create_dir(root, recursive=True)
                sink = files.open_output_stream(f"{root}/{name}.bin")
            ids, stops = own.encode([t or "" for t in batch.column("text").to_pylist()])
            sink.write(np.insert(ids, stops, end_id).astype(f"<u{width}").tobytes())
            sizes.append(np.diff(stops, prepend=0) + 1)
            names += batch.column("doc_id").to_pylist()
        if sink is None:
            return
        sink.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        doc_ids = np.array([n or 0 for n in names], np.int64)
        empty = np.array([n is None for n in names], np.int64)
        with files.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(np.concatenate([[len(names)], offsets, doc_ids, empty]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([name]), pa.array([len(names)], pa.int64()),
             pa.array([int(offsets[-1])], pa.int64()), pa.array([width], pa.int32())],
            ["part", "name", "docs", "ids", "width"])

    return run


def write_token_files(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int = 0,
                      parts: int | None = None) -> DataFrame:
    """Write the files and return the manifest: ``part, name, docs, ids, width, base``.

    ``base`` is the place of a pair's first id among all ids. The manifest has one row per task
    that wrote; its counts are summed on the driver.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id, or of none, may be many: the beginning of the text parts them too
    ordered = texts.repartitionByRange(parts, F.col("doc_id"), F.substring("text", 1, PARTED)).sortWithinPartitions(
        "doc_id", "text")
    rows = cut(ordered.mapInArrow(_written(folder, path, pattern, end_id), MANIFEST), "manifest")
    found = sorted(tuple(r) for r in rows.collect())
    bases = [0, *accumulate(r[3] for r in found)]
    return spark.createDataFrame(
        [(*r, b) for r, b in zip(found, bases, strict=False)], MANIFEST + ", base long")


def _mapped(files: pfs.FileSystem, name: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where the store is a file system, else read."""
    if isinstance(files, pfs.LocalFileSystem):
        return np.memmap(name, dtype=kind, mode="r")
    with files.open_input_file(name) as source:
        return np.frombuffer(source.read_buffer(), kind)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = storage(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = _mapped(files, f"{root}/{row['name']}.idx", "<i8")
                ids = _mapped(files, f"{root}/{row['name']}.bin", f"<u{row['width']}")
                n = int(index[0])
                offsets, own, empty = index[1 : n + 2], index[n + 2 : 2 * n + 2], index[2 * n + 2 :]
                for at in range(0, n, 4096):
                    stop = min(n, at + 4096)
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes())
                            for a, b in zip(offsets[at:stop], offsets[at + 1 : stop + 1], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(own[at:stop]), mask=np.asarray(empty[at:stop]) == 1),
                         pa.array(np.asarray(offsets[at:stop]) + row["base"]),
                         pa.array(np.diff(offsets[at : stop + 1])), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``, from the files alone."""
    parts = max(1, manifest.count())
    return manifest.repartition(parts, "part").mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, pattern: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` under the shared folder and read the files back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, path, pattern, end_id), folder)
