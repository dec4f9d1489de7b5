"""Word BPE by a pair occurrence index, over whole texts, and its decoding.

A task cuts its texts at spaces and line breaks, which this kind of tokenizer drops, and looks at each
distinct chunk once. The words of all new chunks are laid out one after another as one row of symbols.
An index maps every pair of neighbours that has a rank to the list of all its positions. Active ranks are
taken in ascending order from a heap: each position of the pair is merged from left to right, and the
two pairs that the merge makes with its neighbours are added to their own lists (and to the heap, where
they are new there). A position that another merge has changed since it was listed is passed over. A rank
whose product takes part in a pair of a lower rank is applied to one position of each word at a time, so
the result is the one of merging word by word for any list of merges.

Nothing is shuffled: a text is encoded where it was read, and a lost task repeats its texts only.
What a task remembers of earlier words is bounded by ``remembered``; a text of any length is taken in
slices that end at a space. A text without spaces is one slice.

Decoding joins ids to the token table (the vocabulary, of fixed size) inside the task and puts one space
between tokens, as the library does for a file that names no decoder.

Nulls: a null text is empty and has no tokens; a null id stays null. Rows that repeat an id give a row
each. Empty tables give no rows; other columns, whatever their names, are not read. There are no ties:
of equal pairs in a word the leftmost is merged first. An added token's string (``<|endoftext|>``) in a
text becomes that token, as the library does by default.
"""

from __future__ import annotations

import heapq
import json
import re
from bisect import bisect
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.bpe import splitters
from remitmatch.llm.common import small_batches
from remitmatch.llm.tokenfiles import tokenizer

SLICE = 4 << 20  # characters of a text worked on at a time
SYMBOLS = 1 << 21  # symbols laid out in one row


class Merges:
    """The ranked pairs of a vocabulary file and the index that applies them."""

    def __init__(self, model: dict):
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.edge = max(self.vocab.values()) + 1  # stands between words
        self.span = self.edge + 1
        self.pairs, self.product = [], []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.append((self.vocab[left], self.vocab[right]))
            self.product.append(self.vocab[left + right])
        self.ranks = {a * self.span + b: r for r, (a, b) in reversed(list(enumerate(self.pairs)))}
        lowest: dict[int, int] = {}
        for r, pair in enumerate(self.pairs):
            for symbol in pair:
                lowest.setdefault(symbol, r)
        self.early = {r for r, made in enumerate(self.product) if lowest.get(made, r) < r}
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int64)

    def symbols(self, word: str) -> list[int]:
        """The ids of a word's characters, the last one marked as the end of a word."""
        return [*map(self.vocab.__getitem__, word[:-1]), self.vocab[word[-1] + self.suffix]]

    def index(self, row: np.ndarray) -> dict[int, list[int]]:
        """All positions of every ranked pair of neighbours, by rank."""
        keys = row[:-1] * self.span + row[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        places = np.flatnonzero(self.keys[at] == keys) if len(self.keys) else np.zeros(0, np.int64)
        if not len(places):
            return {}
        found = self.key_ranks[at[places]]
        order = np.argsort(found, kind="stable")
        places, found = places[order], found[order]
        cuts = np.flatnonzero(np.diff(found, prepend=-1))
        return {int(found[a]): p.tolist() for a, p in zip(cuts, np.split(places, cuts[1:]), strict=True)}

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word (none empty), as little-endian unsigned 32-bit integers."""
        row, starts = [self.edge], []
        for word in words:
            starts.append(len(row))
            row += self.symbols(word)
            row.append(self.edge)
        index = self.index(np.array(row, np.int64))
        after, before = list(range(1, len(row) + 1)), list(range(-1, len(row) - 1))
        ranks, span = self.ranks, self.span
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            places = sorted(index.pop(rank))
            (left, right), made = self.pairs[rank], self.product[rank]
            one_each, last, later = rank in self.early, -1, []
            for p in places:
                if row[p] != left:
                    continue
                q = after[p]
                if row[q] != right:
                    continue
                if one_each:
                    if (word := bisect(starts, p)) == last:
                        later.append(p)
                        continue
                    last = word
                row[p], row[q] = made, -1
                n = after[p] = after[q]
                before[n] = p
                b = before[p]
                for place, key in ((b, row[b] * span + made), (p, made * span + row[n])):
                    more = ranks.get(key)
                    if more is not None:
                        if more in index:
                            index[more].append(place)
                        else:
                            index[more] = [place]
                            heapq.heappush(active, more)
            if later:
                if rank in index:
                    index[rank] += later
                else:
                    index[rank] = later
                    heapq.heappush(active, rank)
        left_over = np.array(row, np.int64)
        left_over = left_over[left_over >= 0]
        edges = np.flatnonzero(left_over == self.edge).tolist()
        data = left_over.astype("<u4").tobytes()
        return [data[4 * a + 4 : 4 * b] for a, b in zip(edges, edges[1:], strict=False)]


class Words:
    """A vocabulary file: chunks of text to words, words to ids, ids to tokens."""

    def __init__(self, path: str, remembered: int = 640_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges, self.remembered = Merges(spec["model"]), remembered
        self.library = tokenizer(path)
        added = spec.get("added_tokens") or []
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that are matched after normalising or take white space are not supported")
        if [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str("a b")] != ["a", "b"]:
            raise ValueError("the tokenizer keeps white space, so texts cannot be cut there")
        self.added = {t["content"]: t["id"] for t in added}
        self.special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.tokens = [""] * (max([*self.merges.vocab.values(), *self.added.values()]) + 1)
        for token, i in {**self.merges.vocab, **self.added}.items():
            self.tokens[i] = token
        self.plain = self.ascii_words(spec)
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def ascii_words(spec: dict):
        """How chunks of printable ASCII fall into words, where the file's steps are the ones known here."""
        steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
            return None
        split, level = cuts
        if not split.get("invert") or split.get("behavior") != "Removed" or level.get("add_prefix_space") or level.get("use_regex"):
            return None
        return splitters(split["pattern"]["Regex"].replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}"))[1]

    def split(self, chunk: str) -> list[str | int]:
        """The words of a chunk as the library's own steps give them, and the ids of added tokens."""
        found: list[str | int] = []
        for part in self.special.split(chunk) if self.special else [chunk]:
            if part in self.added:
                found.append(self.added[part])
            elif self.plain and part.isascii() and part.isprintable():
                found += [part.lower()] if part.isalpha() else self.plain(part.lower())
            elif part:
                if self.library.normalizer:
                    part = self.library.normalizer.normalize_str(part)
                found += [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return found

    def learn(self, chunks: Iterable[str]) -> None:
        """Ids of chunks not met before, as little-endian unsigned 32-bit integers."""
        split = {chunk: self.split(chunk) for chunk in chunks}
        new = sorted({w for words in split.values() for w in words if isinstance(w, str)}.difference(self.words))
        start = 0
        while start < len(new):
            stop, size = start, 0
            while stop < len(new) and (stop == start or size + len(new[stop]) <= SYMBOLS):
                size += len(new[stop])
                stop += 1
            group = new[start:stop]
            self.words.update(zip(group, self.merges.encode(group), strict=True))
            start = stop
        for chunk, words in split.items():
            parts = [self.words[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in words]
            self.known[chunk] = parts[0] if len(parts) == 1 else b"".join(parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text (together no longer than one slice, or a single text)."""
        if len(self.known) > self.remembered or len(self.words) > self.remembered:
            self.known, self.words = {}, {}
        split = [text.replace("\n", " ").split(" ") for text in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(new)
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One for all tasks of a worker."""
    return Words(path)


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in parts of about ``size`` characters that end before a space."""
    start = 0
    while len(text) - start > size:
        stop = text.find(" ", start + size)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:] if start else text


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in small_batches(batches, "text", SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if len(texts) == 1:
                found = [b"".join(words.encode([part])[0] for part in slices(texts[0]))]
            else:
                found = words.encode(texts)
            ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"])

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, an array of integers."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def _decoded(path: str, limit: int = 1 << 21):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = words_of(path).tokens.__getitem__
        for batch in batches:
            column = batch.column("ids")
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy()
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
                texts = [" ".join(map(token, values[a:b].tolist()))
                         for a, b in zip(ends[start:stop], ends[start + 1 : stop + 1], strict=True)]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])
                start = stop

    return run


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the text that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoded(path), "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``; a task encodes and decodes in one worker."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encode, decode = _encoded(path), _decoded(path)
    decoded = texts.mapInArrow(lambda batches: decode(encode(batches)), "doc_id long, ids array<int>, decoded string")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
