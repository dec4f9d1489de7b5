"""Alignment of two tokenizers over a corpus, with pairs of ids counted by external spill counting.

Side A is a byte-level BPE, side B a piece BPE with byte fallback. A text is cut before single spaces and line
breaks that stand between other characters: no token of either side crosses such a place (checked on the vocabularies),
so a chunk aligns alike wherever it stands and each distinct chunk is tokenized once in a block of texts.
Byte offsets where tokens of both sides end cut a chunk into groups; every A token of a group is
linked with every B token of it.

1. **Runs.** A block of about ``BLOCK`` bytes of texts makes its pair-document records, one for each document and distinct
   linked pair, and counts them by pair. Sorted by radix (the A id modulo ``RADIX``), A id and
   B id they are cut into one run per radix, compressed with zstd. A run's rows grow with the distinct
   pairs of a block, not with documents, so a frequent pair costs no more than a rare one.
2. **Merge.** Runs of a radix are merged over a heap of their next A ids: all of a pair's counts meet, and
   when the A id changes, its highest count is known. Where more than ``FAN_IN`` blocks exist, groups of about that many
   runs are merged to one run first, level by level, so that no task holds more than a group.
3. **Way back.** The last merge streams, for each run and in its order, the corpus-wide count of every pair and
   whether it is its A id's highest; levels hand them down the same groups. A block adds them up
   over its chunks, and the chunks over its documents.

Nulls: a null or empty text, and a text whose joined tokens differ from the text (one that holds U+2581), has
no tokens: zeros and an empty digest. A null id stays null. Rows that repeat an id are documents of their
own. Ties for the highest count all count as highest. Empty tables give no rows; other columns, whatever their names,
are not read. A text of any length is whole in one block; equal ids in a long group are combined before
they are paired.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.bpe import gather
from remitmatch.llm.common import cut, release, small_batches

BLOCK = 8 << 20
RADIX = 128
FAN_IN = 256
REMEMBERED = 400_000  # chunks kept from one block to the next
SLICE = 4 << 20

# U+180E counts as white space in some versions of Unicode, so nothing is cut beside it
_CUT = re.compile("(?<=[^\\s᠎])(?=[ \n][^\\s᠎])")
_REGULAR = re.compile("[ \n][^\\s᠎](?:.*[^\\s᠎])?", re.DOTALL)
_LEAD = " a"  # a chunk of its own before others that are tokenized in one go
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(sizes)]), sizes


class ByteSide:
    """A byte-level BPE of the tokenizers library; special tokens in a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letters = {chr(b): b for b in own}
        letters |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)).difference(own)))}
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(letters[c] for c in token)
        self.data, self.offsets, self.sizes = _table(tokens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """A piece BPE of the sentencepiece library, for texts that begin with the space that it adds itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(count)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("pieces cross spaces or line breaks, so texts cannot be cut there")
        self.data, self.offsets, self.sizes = _table([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]


class Aligner:
    """What is known of the chunks met so far, by chunk number; all tasks of a worker share one."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        count = max(len(self.a.sizes), len(self.b.sizes))
        self.labels = [f"{i}{end}".encode() for i in range(count) for end in ("", ",", "|", ";")]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[bytes | None] = []  # None: the tokens differ from the chunk
        self.totals = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.offsets = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def number(self, text: str) -> np.ndarray:
        """The numbers of the text's chunks in order; new chunks get the next ones."""
        numbers, found, start = self.numbers, [], 0
        while start < len(text):
            stop = _CUT.search(text, start + SLICE) if len(text) - start > SLICE else None
            chunks = _CUT.split(text[start : stop.start()] if stop else text[start:])
            for chunk in set(chunks).difference(numbers):
                numbers[chunk] = len(numbers)
            found.append(np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks)))
            start = stop.start() if stop else len(text)
        return np.concatenate(found)

    def learn(self) -> None:
        """Align the chunks that were numbered since the last call."""
        start = len(self.groups)
        new = list(self.numbers)[start:]
        if not new:
            return
        texts: list[list[str]] = []
        places: list[list[int]] = []
        group, regular, size = [], [], 0
        for k, chunk in enumerate(new):
            if not _REGULAR.fullmatch(chunk) or "▁" in chunk:
                texts.append([_LEAD, chunk] if chunk[0] == "\n" else [chunk])
                places.append([-1, k] if chunk[0] == "\n" else [k])
                continue
            if not regular or size > 1 << 14:
                group, regular, size = [_LEAD], [-1], 0
                texts.append(group)
                places.append(regular)
            group.append(chunk)
            regular.append(k)
            size += len(chunk)
        self.groups += [None] * len(new)
        totals = np.zeros((len(new), 4), np.int64)
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while texts:
            again: list[tuple[list[str], list[int]]] = []
            joined = ["".join(parts) for parts in texts]
            for parts, place, whole, ids_a, ids_b in zip(
                    texts, places, joined, self.a.encode(joined), self.b.encode(joined), strict=True):
                ends = np.cumsum([len(p.encode()) for p in parts])
                found = self.align(whole.encode(), ids_a, ids_b, ends)
                if found is None:
                    rest = [(p, k) for p, k in zip(parts, place, strict=True) if k >= 0]
                    if len(rest) > 1:
                        again += [([_LEAD, p], [-1, k]) if p[0] == "\n" else ([p], [k]) for p, k in rest]
                    continue
                strings, sums, owner, keys, times = found
                own = np.array(place)
                for k, string in zip(place, strings, strict=True):
                    if k >= 0:
                        self.groups[start + k] = string
                totals[own[own >= 0]] = sums[own >= 0]
                held = own[owner] >= 0
                pairs.append((own[owner[held]], keys[held], times[held]))
            texts, places = [t for t, _ in again], [p for _, p in again]
        owner, keys, times = (np.concatenate(c) for c in zip(*pairs, strict=True))
        order = np.argsort(owner, kind="stable")
        self.totals = np.concatenate([self.totals, totals])
        self.pairs = np.concatenate([self.pairs, keys[order]])
        self.times = np.concatenate([self.times, times[order]])
        sizes = np.bincount(owner, minlength=len(new))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])

    def align(self, whole: bytes, ids_a: np.ndarray, ids_b: np.ndarray, ends: np.ndarray):
        """For the chunks that end at ``ends``: group strings, totals, and pairs with their chunk and number of links.

        None where the tokens of a side do not spell the text or cross the end of a chunk.
        """
        for side, ids in ((self.a, ids_a), (self.b, ids_b)):
            if gather(side.data, side.offsets, ids)[0].tobytes() != whole:
                return None
        end_a, end_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        borders = np.intersect1d(end_a, end_b, assume_unique=True)
        if not np.isin(ends, borders).all():
            return None
        group_a, group_b = np.searchsorted(borders, end_a), np.searchsorted(borders, end_b)
        chunk = np.searchsorted(ends, borders)
        count = len(borders)
        size_a, size_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        sums = np.zeros((len(ends), 4), np.int64)
        for column, values in enumerate((size_a, size_b, np.ones(count, np.int64), size_a * size_b)):
            np.add.at(sums[:, column], chunk, values)
        # the strings: A's ids, then B's, group by group; 0 nothing, 1 comma, 2 bar, 3 semicolon after each
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        final = np.append(chunk[1:] != chunk[:-1], True)
        mark = np.concatenate([
            np.where(last_a, 2, 1), np.where(last_b, np.where(final[group_b], 0, 3), 1)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        labels = list(map(self.labels.__getitem__, (np.concatenate([ids_a, ids_b]) * 4 + mark)[order].tolist()))
        stops = np.cumsum(sums[:, 0] + sums[:, 1]).tolist()
        strings = [b"".join(labels[x:y]) for x, y in zip([0, *stops], stops, strict=False)]
        # equal ids of a group once, with how often they stand there, before they are paired
        set_a, n_a = np.unique(group_a << 24 | ids_a, return_counts=True)
        set_b, n_b = np.unique(group_b << 24 | ids_b, return_counts=True)
        set_b_starts = np.searchsorted(set_b, np.arange(count + 1) << 24)
        own = set_a >> 24
        sizes = set_b_starts[own + 1] - set_b_starts[own]
        left = np.repeat(np.arange(len(set_a)), sizes)
        right = np.arange(len(left)) + np.repeat(set_b_starts[own] - (np.cumsum(sizes) - sizes), sizes)
        low = (1 << 24) - 1
        keys = pair_keys(set_a[left] & low, set_b[right] & low)
        return strings, sums, chunk[own[left]], keys, n_a[left] * n_b[right]


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A pair as one number that sorts by radix, A id and B id (ids below 2**24)."""
    return a % RADIX << 48 | a << 24 | b


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0, each as its length and the planes of its bytes, in zstd."""
    parts = []
    for values in arrays:
        planes = (int(values.max(initial=0)).bit_length() + 7) // 8
        parts.append(len(values).to_bytes(8, "little") + planes.to_bytes(1, "little"))
        parts += [(values >> 8 * k).astype(np.uint8).tobytes() for k in range(planes)]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(
        pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    arrays, at = [], 0
    while at < len(raw):
        size, planes = int.from_bytes(raw[at : at + 8].tobytes(), "little"), int(raw[at + 8])
        at += 9
        values = np.zeros(size, np.int64)
        for k in range(planes):
            values |= raw[at : at + size].astype(np.int64) << 8 * k
            at += size
        arrays.append(values)
    return arrays


def _run(keys: np.ndarray, docs: np.ndarray) -> bytes:
    """Pairs of one radix in order, with how many documents hold each: A ids, their sizes, B ids, counts."""
    a = keys >> 24 & (1 << 24) - 1
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    return _squeezed(a[starts], np.diff(np.append(starts, len(a))), keys & (1 << 24) - 1, docs)


def _blocks(path_a: str, path_b: str, limit: int):
    """A row for each block: its documents' digests, its runs, and what the way back needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        serial = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, "text", limit):
            if len(own.numbers) > REMEMBERED:
                own.forget()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            numbers = [own.number(" " + t) if t else np.zeros(0, np.int64) for t in texts]
            del texts
            own.learn()
            groups = own.groups.__getitem__
            digests = []
            for k, found in enumerate(numbers):
                strings = list(map(groups, found.tolist()))
                if not strings or None in strings:
                    numbers[k] = found[:0]
                    digests.append("")
                else:
                    digests.append(hashlib.sha256(b";".join(strings)).hexdigest())
            ends = np.cumsum([0, *map(len, numbers)])
            flat = np.concatenate(numbers)
            del numbers
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(own.totals[flat], axis=0)])
            sums = sums[ends[1:]] - sums[ends[:-1]]
            used, flat = np.unique(flat, return_inverse=True)
            entries, stops = gather(own.pairs, own.offsets, used)
            times = gather(own.times, own.offsets, used)[0]
            pairs, entries = np.unique(entries, return_inverse=True)
            offsets = np.concatenate([[0], stops])
            # each document's distinct chunks and how often it holds them
            words, counts = np.unique(
                np.repeat(np.arange(len(digests)), np.diff(ends)) * max(1, len(used)) + flat, return_counts=True)
            owner, words = words // max(1, len(used)), words % max(1, len(used))
            docs = np.zeros(len(pairs), np.int64)
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(digests)))])
            links = np.concatenate([[0], np.cumsum((offsets[1:] - offsets[:-1])[words])])
            start = 0
            while start < len(digests):  # the pair-document records of some documents at a time
                base = links[per_doc[start]]
                stop = max(start + 1, int(np.searchsorted(links[per_doc], base + (1 << 21), side="right")) - 1)
                part = slice(per_doc[start], per_doc[stop])
                held, _ = gather(entries, offsets, words[part])
                whose = np.repeat(owner[part] - start, (offsets[1:] - offsets[:-1])[words[part]])
                records = np.unique(whose * max(1, len(pairs)) + held)
                docs += np.bincount(records % max(1, len(pairs)), minlength=len(pairs))[: len(pairs)]
                start = stop
            radix = np.searchsorted(pairs, np.arange(RADIX + 1) << 48)
            yield pa.RecordBatch.from_arrays(
                [pa.array([serial], pa.int64()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([sums.ravel()], pa.list_(pa.int64())),
                 pa.array([digests], pa.list_(pa.string())),
                 pa.array([_squeezed(np.diff(per_doc), words, counts)], pa.binary()),
                 pa.array([_squeezed(np.diff(offsets), entries, times)], pa.binary()),
                 pa.array([[_run(pairs[x:y], docs[x:y]) if y > x else None
                            for x, y in zip(radix[:-1], radix[1:], strict=True)]], pa.list_(pa.binary()))],
                ["block", "doc_ids", "sums", "digests", "documents", "chunks", "runs"])
            serial += 1

    return run


def _merged(runs: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """Merge runs over a heap of their next A ids.

    For each A id in order: its B ids, the documents that hold each, and for every run that has the A id the
    places of the run's pairs among them.
    """
    opened = [_opened(run) for run in runs]
    starts = [np.cumsum([0, *sizes.tolist()]) for _, sizes, _, _ in opened]
    at = [0] * len(runs)
    heap = [(int(o[0][0]), k) for k, o in enumerate(opened)]
    heapq.heapify(heap)
    while heap:
        a, having = heap[0][0], []
        while heap and heap[0][0] == a:
            k = heap[0][1]
            place = at[k]
            having.append((k, slice(starts[k][place], starts[k][place + 1])))
            at[k] = place = place + 1
            if place < len(opened[k][0]):
                heapq.heapreplace(heap, (int(opened[k][0][place]), k))
            else:
                heapq.heappop(heap)
        ids, where = np.unique(np.concatenate([opened[k][2][s] for k, s in having]), return_inverse=True)
        docs = np.zeros(len(ids), np.int64)
        np.add.at(docs, where, np.concatenate([opened[k][3][s] for k, s in having]))
        cuts = np.cumsum([s.stop - s.start for _, s in having])[:-1]
        yield a, ids, docs, [(k, w) for (k, _), w in zip(having, np.split(where, cuts), strict=True)]


def _joined_runs(key: tuple, table: pa.Table) -> pa.Table:
    """One run of a group of runs."""
    radix, group = key[0].as_py(), key[1].as_py()
    a, sizes, b, docs = [], [], [], []
    for side, ids, counts, _ in _merged(table.column("run").to_pylist()):
        a.append(side)
        sizes.append(len(ids))
        b.append(ids)
        docs.append(counts)
    run = _squeezed(np.array(a, np.int64), np.array(sizes, np.int64), np.concatenate(b), np.concatenate(docs))
    return pa.table([pa.array([group], pa.int64()), pa.array([radix], pa.int32()), pa.array([run], pa.binary())],
                    ["block", "radix", "run"])


def _answers(blocks: list[int], radix: int, counts: list[list[np.ndarray]], best: list[list[np.ndarray]]) -> pa.Table:
    return pa.table(
        [pa.array(blocks, pa.int64()), pa.array([radix] * len(blocks), pa.int32()),
         pa.array([_squeezed(np.concatenate(c), np.concatenate(x)) for c, x in zip(counts, best, strict=True)],
                  pa.binary())], ["block", "radix", "answer"])


def _settled(key: tuple, table: pa.Table) -> pa.Table:
    """The last merge: for each run, in its order, corpus-wide counts and whether they are an A id's highest."""
    blocks = table.column("block").to_pylist()
    counts: list[list[np.ndarray]] = [[] for _ in blocks]
    best: list[list[np.ndarray]] = [[] for _ in blocks]
    for _, _, docs, having in _merged(table.column("run").to_pylist()):
        top = (docs == docs.max()).astype(np.int64)
        for k, where in having:
            counts[k].append(docs[where])
            best[k].append(top[where])
    return _answers(blocks, key[0].as_py(), counts, best)


def _handed_down(key: tuple, runs: pa.Table, above: pa.Table) -> pa.Table:
    """The answers of a group's run, for each of the runs it was merged from."""
    docs, top = _opened(above.column("answer")[0].as_py())
    blocks = runs.column("block").to_pylist()
    counts: list[list[np.ndarray]] = [[] for _ in blocks]
    best: list[list[np.ndarray]] = [[] for _ in blocks]
    start = 0
    for _, ids, _, having in _merged(runs.column("run").to_pylist()):
        for k, where in having:
            counts[k].append(docs[start + where])
            best[k].append(top[start + where])
        start += len(ids)
    return _answers(blocks, key[0].as_py(), counts, best)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            answers = [_opened(e["answer"]) for e in sorted(row["answers"] or (), key=lambda e: e["radix"])]
            empty = [np.zeros(0, np.int64)]
            counts = np.concatenate([c for c, _ in answers] or empty)
            best = np.concatenate([x for _, x in answers] or empty)
            per_chunk, entries, times = _opened(row["chunks"])
            per_doc, words, held = _opened(row["documents"])
            chunk_ends = np.cumsum(np.append(0, per_chunk))
            doc_ends = np.cumsum(np.append(0, per_doc))
            found = []
            for values in (best, counts):
                links = np.append(0, np.cumsum(times * values[entries]))
                chunk = links[chunk_ends[1:]] - links[chunk_ends[:-1]]
                total = np.append(0, np.cumsum(held * chunk[words]))
                found.append(total[doc_ends[1:]] - total[doc_ends[:-1]])
            sums = np.array(row["sums"], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), *(pa.array(sums[:, k]) for k in range(4)),
                 *map(pa.array, found), pa.array(row["digests"], pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def _counted(runs: DataFrame, blocks: int, fan_in: int) -> DataFrame:
    """``block, radix, answer`` for each run (``block, radix, run``)."""
    kind = "block long, radix int, answer binary"
    if blocks <= fan_in:
        return cut(runs.groupBy("radix").applyInArrow(_settled, kind), "answers")
    groups = -(-blocks // fan_in)
    dealt = runs.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    above = cut(dealt.groupBy("radix", "group").applyInArrow(
        _joined_runs, "block long, radix int, run binary"), "runs")
    answers = _counted(above, groups, fan_in).withColumnRenamed("block", "group")
    return cut(dealt.groupBy("radix", "group").cogroup(answers.groupBy("radix", "group")).applyInArrow(
        _handed_down, kind), "answers")


def align_documents(docs: DataFrame, path_a: str, path_b: str, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = cut(texts.mapInArrow(
        _blocks(path_a, path_b, block),
        "block long, doc_ids array<long>, sums array<long>, digests array<string>, documents binary, "
        "chunks binary, runs array<binary>"), "blocks")
    runs = blocks.select("block", F.posexplode("runs").alias("radix", "run")).where("run IS NOT NULL")
    answers = _counted(runs, blocks.count(), fan_in)
    release(docs.sparkSession)
    back = answers.groupBy("block").agg(F.collect_list(F.struct("radix", "answer")).alias("answers"))
    return (
        blocks.drop("runs").join(back.hint("merge"), "block", "left")
        .select("doc_ids", "sums", "digests", "documents", "chunks", "answers").mapInArrow(_summed, _RESULT))
