"""Removal of repeated byte strings between documents, by sampled suffixes and deep-shallow sorting.

A string of ``length`` bytes (a window) is removed from a document if it also starts in a document with
a smaller id. Not every suffix is sorted: each window names one anchor, the smallest of its
``gram``-byte hashes, which depends on the window's bytes alone, so equal windows name equal anchors.

1. Every fourth anchor or so, chosen by its hash, cuts a text into stretches. Of equal stretches
   the one in the smallest id is the first; all others are repeats throughout. Copies and near
   copies end here, but for the stretches in which they differ.
2. Anchors are shuffled once and read in their order: those that occur in several different stretches are looked
   up in the first ones. Around each stand the windows that named it: its context.
3. The contexts of an anchor meet in one task. Equal contexts are one class, whose smallest id is known. Where one
   anchor has several contexts that agree in ``(length + gram) / 2`` bytes at least, as equal windows must on one
   side of the anchor, their windows are suffixes to be sorted, if another has the same hash: by multikey quicksort
   to a shallow depth, then each group that still agrees with a blind trie. Neighbours that agree in all bytes are one
   repeat, and only the smallest id keeps it.
4. Anchors with more than ``CROWD`` bytes of contexts are settled between tasks: sides, classes and windows are
   grouped by 128-bit hashes, windows after each task has sorted its own. Their minima are combined before the shuffle.

Nothing is capped: each window of each document is judged.

Nulls: a null text is empty; a row without an id neither loses bytes nor makes others lose any. Rows
that repeat an id are the same document and never each other's source. Texts shorter than
``length`` are kept whole. Empty tables give no rows. Other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import (
    cut, discard, grams, mix, ranges, raw_bytes, release, rolling, small_batches,
)

LENGTH, GRAM = 50, 16
BLOCK = 1 << 18  # bytes worked on at a time
SHALLOW, STEP = 16, 8
STRETCH = np.uint64(4)  # anchors in a stretch, on average
CHUNK, CROWD = 1 << 19, 1 << 20  # bytes of contexts sorted together, and of one anchor's
_LOW = np.uint64((1 << 24) - 1)


# --- anchors ------------------------------------------------------------------------------


class Scan(NamedTuple):
    """Anchors of a block of texts. Places count from the block's start, texts from the batch's."""

    base: int
    data: np.ndarray
    sums: np.ndarray
    hashes: np.ndarray
    place: np.ndarray
    first: np.ndarray  # first window that names the anchor
    last: np.ndarray
    text: np.ndarray
    stretch: np.ndarray  # number of the stretch in the block
    begins: np.ndarray  # first anchor of each stretch

    def stretches(self) -> tuple[np.ndarray, np.ndarray]:
        """First window of each stretch, and the one after its last."""
        ends = np.append(self.begins[1:], len(self.hashes)) - 1
        return self.first[self.begins], self.last[ends] + 1

    def twin(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _twin(self.data, start, stop, self.sums)


def _twin(data: np.ndarray, start: np.ndarray, stop: np.ndarray, sums: np.ndarray | None = None):
    """128-bit hashes of byte ranges, as two 64-bit ones."""
    one = rolling(data) if sums is None else sums
    return tuple(ranges(x, start, stop).astype(np.int64) for x in (one, rolling(data, 1)))


def _pieces(sizes: list[int], length: int) -> Iterator[tuple[int, int]]:
    """Start and stop of the blocks: whole texts together, a longer text by itself in fixed steps.

    So what is found in a text does not depend on the texts beside it.
    """
    base = held = 0
    for size in sizes:
        if held and held + size > BLOCK:
            yield base, base + held
            base, held = base + held, 0
        if size <= BLOCK:
            held += size
            continue
        for start in range(0, size - length + 1, BLOCK):
            yield base + start, base + min(size, start + BLOCK + length - 1)
        base += size
    if held:
        yield base, base + held


def scan(texts: list[bytes], length: int, gram: int) -> Iterator[Scan]:
    """Anchors of all windows of the texts, block by block.

    Windows over two texts are left out. The smallest hash wins (its upper 40 bits), among equal
    ones the first. In a text longer than a block an anchor may come twice, with different windows.
    """
    sizes = [len(t) for t in texts]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    whole = np.frombuffer(b"".join(texts), np.uint8)
    for base, stop in _pieces(sizes, length):
        data = whole[base:stop]
        if len(data) < length:
            continue
        sums = rolling(data)
        hashes = grams(sums, gram)
        least = hashes & ~_LOW
        least |= np.arange(len(hashes), dtype=np.uint64)
        width, reach = length - gram + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: reach - width], least[width - reach :])
        named = least.astype(np.int32) & np.int32(_LOW)
        for end in (ends[np.searchsorted(ends, base, "right") : np.searchsorted(ends, base + len(data))] - base).tolist():
            named[max(0, end - length + 1) : end] = -1  # windows over two texts
        first = np.flatnonzero(named[1:] != named[:-1]) + 1
        first = np.append(0, first)
        last = np.append(first[1:], len(named)) - 1
        own = named[first] >= 0
        first, last = first[own], last[own]
        if not len(first):
            continue
        place = named[first].astype(np.int64)
        text = np.searchsorted(starts, first + base, side="right") - 1
        hashes = hashes[place]
        cuts = (hashes >> np.uint64(40)) % STRETCH == 0
        cuts |= np.append(True, text[1:] != text[:-1])
        yield Scan(base, data, sums, hashes, place, first, last, text,
                   np.cumsum(cuts) - 1, np.flatnonzero(cuts))


def _starts(texts: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *map(len, texts[:-1])])


def _rows(names: list[str], columns: tuple) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
    for at in range(0, whole.num_rows, 1 << 16):
        yield whole.slice(at, 1 << 16)


def _ids(batch: pa.RecordBatch, name: str = "doc_id") -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _stretched(length: int, gram: int):
    """Rows ``doc_id, key, h1, h2, start``: the stretches of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = raw_bytes(batch.column("text"))
            zero, ids, keys = _starts(texts), _ids(batch), _ids(batch, "key")
            for s in scan(texts, length, gram):
                start, stop = s.stretches()
                owner = s.text[s.begins]
                yield from _rows(
                    ["doc_id", "key", "h1", "h2", "start"],
                    (ids[owner], keys[owner], *s.twin(start, stop + length - 1), start + s.base - zero[owner]))

    return run


def _anchored(length: int, gram: int):
    """Rows ``anchor, stretch, doc_id``: each anchor of a text with a hash of the stretch it stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            ids = _ids(batch)
            for s in scan(raw_bytes(batch.column("text")), length, gram):
                start, stop = s.stretches()
                own = ranges(s.sums, start, stop + length - 1)[s.stretch]
                _, one = np.unique(mix(s.hashes + mix(own + s.text.astype(np.uint64))), return_index=True)
                yield from _rows(["anchor", "stretch", "doc_id"], (
                    s.hashes[one].astype(np.int64), own[one].astype(np.int64), ids[s.text[one]]))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``anchor, doc_id`` of anchors that stand in several stretches, with the first id of each stretch.

    The rows of ``_anchored`` come in the order of anchor, stretch and id; of what went before only the last stretch
    is kept, and whether its anchor had another one.
    """
    last, met = [np.zeros(0, np.int64)] * 3, False
    for batch in batches:
        anchor, stretch, ids = (
            np.concatenate([x, _ids(batch, c)]) for x, c in zip(last, ("anchor", "stretch", "doc_id"), strict=True))
        if not len(anchor):
            continue
        again = anchor[1:] == anchor[:-1]
        one = np.flatnonzero(np.append(True, ~again | (stretch[1:] != stretch[:-1])))
        anchor, stretch, ids = anchor[one], stretch[one], ids[one]
        again = anchor[1:] == anchor[:-1]
        shared = np.append(again, False) | np.append(met, again)
        if met:
            shared |= anchor == anchor[0]
        new = shared.copy()
        new[0] &= not met  # given out with the batch before
        yield from _rows(["anchor", "doc_id"], (anchor[new], ids[new]))
        last, met = [anchor[-1:], stretch[-1:], ids[-1:]], bool(shared[-1])


def _context_names(s: Scan, pick: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names of contexts: their bytes and where the anchor stands in them."""
    d1, d2 = s.twin(s.first[pick], s.last[pick] + length)
    lead = (s.place[pick] - s.first[pick]).astype(np.uint64)
    return d1, mix(d2.astype(np.uint64) ^ lead).astype(np.int64)


def _marks(lists: list, zero: np.ndarray) -> np.ndarray:
    """Places in the batch from a list of places for each text, sorted."""
    sizes = [len(x) for x in lists]
    return np.sort(np.concatenate([np.asarray(x, np.int64) for x in lists]) + np.repeat(zero, sizes))


def _mark(d1: np.ndarray, d2: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """One number for a name and the text it stands in."""
    return mix(d1.view(np.uint64) + mix(d2.view(np.uint64) + owner.astype(np.uint64)))


def _found(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values if len(sorted_values) else np.zeros(len(values), bool)


CONTEXT = "anchor long, d1 long, d2 long, doc_id long, lead int, context binary"
SETTLED = CONTEXT + ", bits long"  # a repeat (no context), or a context that is still to be judged


def _contexts(length: int, gram: int):
    """The different contexts of wanted anchors in first stretches of each text, as ``CONTEXT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = raw_bytes(batch.column("text"))
            zero, ids = _starts(texts), _ids(batch)
            lists = batch.column("anchors")
            owner = np.repeat(np.arange(len(texts), dtype=np.uint64), pc.list_value_length(lists).to_numpy())
            wanted = np.sort(mix(lists.flatten().to_numpy().view(np.uint64) + mix(owner)))
            firsts = _marks(batch.column("firsts").to_pylist(), zero)
            for s in scan(texts, length, gram):
                own = _found(s.stretches()[0] + s.base, firsts)[s.stretch]
                pick = np.flatnonzero(own & _found(mix(s.hashes + mix(s.text.astype(np.uint64))), wanted))
                d1, d2 = _context_names(s, pick, length)
                _, one = np.unique(_mark(d1, d2, s.text[pick]), return_index=True)
                pick, d1, d2 = pick[one], d1[one], d2[one]
                data = s.data.tobytes()
                bodies = [data[a : b + length] for a, b in
                          zip(s.first[pick].tolist(), s.last[pick].tolist(), strict=True)]
                yield from _rows([c.split(" ")[0] for c in CONTEXT.split(", ")], (
                    s.hashes[pick].astype(np.int64), d1, d2, ids[s.text[pick]],
                    (s.place[pick] - s.first[pick]).astype(np.int32), pa.array(bodies, pa.binary())))

    return run


def _sides(length: int, gram: int):
    """For each context the strings that two equal windows must share left or right of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "context", 1 << 19):
            bodies = batch.column("context").to_pylist()
            for side, (own, s1, s2) in enumerate(_side_names(bodies, _ids(batch, "lead"), length, gram)):
                at = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1), pa.array(s2), batch.column("d1").take(at), batch.column("d2").take(at),
                     pa.array(np.full(len(own), side), pa.int32())], ["s1", "s2", "d1", "d2", "side"])

    return run


def _side_names(bodies: list[bytes], lead: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """Left, then right: the contexts that reach far enough, and 128-bit hashes of their strings."""
    reach = (length - gram + 1) // 2
    each = np.array([len(b) for b in bodies], np.int64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    anchor = np.cumsum(each) - each + lead
    sums = rolling(data)
    for start, stop, fits in (
        (anchor - reach, anchor + gram, lead >= reach),
        (anchor, anchor + gram + reach, lead + gram + reach <= each),
    ):
        own = np.flatnonzero(fits)
        yield own, *_twin(data, start[own], stop[own], sums)


# --- deep-shallow sorting -----------------------------------------------------------------


class BlindTrie:
    """Orders strings of one length that agree far: inner nodes keep only the depth at which they
    branch and one byte for each branch; a string is compared once, with the leaf it is led to."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | tuple | None = None

    def insert(self, number: int) -> None:
        own = self.strings[number]
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while isinstance(node, tuple):
            node = node[1].get(own[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if own == other:
            node.append(number)
            return
        depth = next(i for i, (x, y) in enumerate(zip(own, other, strict=True)) if x != y)
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][own[node[0]]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][own[depth]] = [number]
            return
        fork = (depth, {other[depth]: node, own[depth]: [number]})
        if above is None:
            self.root = fork
        else:
            above[1][own[above[0]]] = fork

    def leaves(self) -> Iterator[list[int]]:
        """Groups of equal strings in ascending order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def multikey_sorted(matrix: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows in ascending order of their first ``depth`` bytes, piece by piece, with the places in a
    piece where a new group of rows that agree in them begins.

    Multikey quicksort, ``STEP`` bytes a key: a pivot splits the rows into smaller, equal and larger
    ones, and the equal ones go on with the next key. Short ranges are ordered by the library.
    """
    keys = np.ascontiguousarray(matrix[:, :depth]).view(f">u{STEP}").astype(np.uint64)
    stack = [(np.arange(len(matrix)), 0)] if len(matrix) else []
    while stack:
        rows, k = stack.pop()
        if k == keys.shape[1]:
            yield rows, np.zeros(1, np.int64)
        elif len(rows) <= 1 << 15:
            own = keys[rows, k:]
            order = np.lexsort(own.T[::-1])
            own = own[order]
            yield rows[order], np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
        else:
            own = keys[rows, k]
            pivot = np.sort(own[[0, len(own) // 2, -1]])[1]
            larger, smaller = rows[own > pivot], rows[own < pivot]
            if len(larger):
                stack.append((larger, k))
            stack.append((rows[own == pivot], k + 1))
            if len(smaller):
                stack.append((smaller, k))


def sorted_repeats(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in ascending order and where groups of equal rows begin: shallow by multikey quicksort,
    deep by blind tries."""
    length = matrix.shape[1]
    data = matrix.tobytes()
    order, begins, done = [], [], 0
    for rows, starts in multikey_sorted(matrix, min(SHALLOW, length // STEP * STEP)):
        stops = np.append(starts[1:], len(rows))
        deep = stops - starts > 1
        rows = rows.copy()
        begin = [starts[~deep]]
        for a, b in zip(starts[deep].tolist(), stops[deep].tolist(), strict=True):
            group = rows[a:b].tolist()
            trie = BlindTrie([data[i * length : (i + 1) * length] for i in group])
            for i in range(len(group)):
                trie.insert(i)
            at = a
            for leaf in trie.leaves():
                begin.append([at])
                rows[at : at + len(leaf)] = [group[i] for i in leaf]
                at += len(leaf)
        order.append(rows)
        begins.append(np.sort(np.concatenate(begin)).astype(np.int64) + done)
        done += len(rows)
    if not order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(order), np.concatenate(begins)


def _spots(bodies: list[bytes], lead: np.ndarray, sides: np.ndarray, length: int, gram: int) -> tuple:
    """The windows of the contexts' open sides: bytes of all contexts, where each window begins in them, the
    context's row, number in the context."""
    reach = (length - gram + 1) // 2
    count = np.array([len(b) - length + 1 for b in bodies], np.int64)
    owner = np.repeat(np.arange(len(bodies)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    before = lead.astype(np.int64)[owner] - number  # bytes of each window before the anchor
    open_ = (sides[owner] & 1 > 0) & (before >= reach)
    open_ |= (sides[owner] & 2 > 0) & (length - gram - before >= reach)
    owner, number = owner[open_], number[open_]
    start = np.cumsum(count + length - 1) - (count + length - 1)
    return np.frombuffer(b"".join(bodies), np.uint8), start[owner] + number, owner, number


def _windows(batch: pa.RecordBatch, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with the windows' bytes as rows of a matrix."""
    data, spot, owner, number = _spots(
        batch.column("context").to_pylist(), _ids(batch, "lead"), _ids(batch, "sides"), length, gram)
    if not len(owner):
        return np.zeros((0, length), np.uint8), owner, number
    return sliding_window_view(data, length)[spot], owner, number


def _row_hashes(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of the rows, some thousand at a time."""
    parts = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(matrix), 4096):
        rows = matrix[at : at + 4096]
        start = np.arange(len(rows)) * rows.shape[1]
        parts.append(_twin(rows.reshape(-1), start, start + rows.shape[1]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _block_repeats(length: int, gram: int):
    """One row for each different window of the task: its hash, smallest and largest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "context", 1 << 19):
            matrix, owner, _ = _windows(batch, length, gram)
            order, begins = sorted_repeats(matrix)
            low = _ids(batch, "low")[owner[order]]
            w1, w2 = _row_hashes(matrix[order[begins]])
            least, most = ((f.reduceat(low, begins) if len(begins) else low) for f in (np.minimum, np.maximum))
            yield from _rows(["w1", "w2", "low", "high"], (w1, w2, least, most))

    return run


def _named_windows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "context", 1 << 19):
            matrix, owner, number = _windows(batch, length, gram)
            yield from _rows(
                ["w1", "w2", "id", "low", "number"],
                (*_row_hashes(matrix), _ids(batch, "id")[owner], _ids(batch, "low")[owner], number.astype(np.int32)))

    return run


def _judged(length: int, gram: int, crowd: int):
    """Rows of ``SETTLED`` from the contexts, which come in the order of their anchors.

    Equal windows name equal anchors, so all contexts of an anchor that a window can be repeated in are here. Those of an
    anchor with more than ``crowd`` bytes of them are handed on as they are.
    """
    columns = [c.split(" ")[0] for c in CONTEXT.split(", ")]

    def rest(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.nulls(part.num_rows, pa.int64())], [*columns, "bits"])

    def hits(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()
        for batch in rows:
            pick, bits = _hits(batch, length, gram)
            at, none = pa.array(pick), pa.nulls(len(pick))
            yield pa.RecordBatch.from_arrays([
                none.cast(pa.int64()), *(batch.column(c).take(at) for c in ("d1", "d2", "doc_id")),
                none.cast(pa.int32()), none.cast(pa.binary()), pa.array(bits, mask=bits == -1)], [*columns, "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[pa.RecordBatch] = []
        last: list[pa.RecordBatch] = []  # of the last anchor, which may go on
        name, crowded = None, False
        for batch in batches:
            anchors = _ids(batch, "anchor")
            if not len(anchors):
                continue
            same = int(np.searchsorted(anchors, name, "right")) if name is not None else 0
            tail = int(np.searchsorted(anchors, anchors[-1]))
            if same:
                last.append(batch.slice(0, same))
            if same < len(anchors):
                if crowded:
                    yield from rest(last)
                    last = []
                whole += [*last, batch.slice(same, tail - same)]
                last, name, crowded = [batch.slice(tail)], anchors[-1], False
            crowded = crowded or sum(x.nbytes for x in last) > crowd
            if crowded:
                yield from rest(last)
                last = []
            if sum(x.nbytes for x in whole) > CHUNK:
                yield from hits(whole)
                whole = []
        if whole or last:
            yield from hits(whole + last)

    return run


def _hits(batch: pa.RecordBatch, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of contexts that hold repeats, and which windows are (-1: all). All contexts of each anchor are given."""
    anchor, d1, d2, ids, lead = (_ids(batch, c) for c in ("anchor", "d1", "d2", "doc_id", "lead"))
    order = np.lexsort((ids, d2, d1, anchor))
    new = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in (anchor, d1, d2)], axis=0))
    head = order[np.flatnonzero(new)]  # of each class, in its smallest id
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    low = ids[head]
    mask = np.zeros(len(head), np.int64)
    another = anchor[head][1:] == anchor[head][:-1]
    rival = np.flatnonzero(np.append(False, another) | np.append(another, False))
    bodies = batch.column("context").take(pa.array(head[rival])).to_pylist()
    lead = lead[head[rival]]
    names = [(own, _mark(s1, s2, np.zeros(len(s1)))) for own, s1, s2 in _side_names(bodies, lead, length, gram)]
    _, which, count = np.unique(np.concatenate([x for _, x in names]), return_inverse=True, return_counts=True)
    met = count[which] > 1
    sides = np.zeros(len(rival), np.int64)
    for side, (own, found) in enumerate(zip((x for x, _ in names), np.split(met, [len(names[0][0])]), strict=True)):
        sides[own[found]] |= 1 << side
    data, spot, owner, number = _spots(bodies, lead, sides, length, gram)
    name = ranges(rolling(data), spot, spot + length)
    _, which, count = np.unique(name, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[which] > 1)  # others are no repeats
    if len(twice):
        # equal hashes only name candidates; the sort tells which bytes are equal
        owner, number = rival[owner[twice]], number[twice]
        order, begins = sorted_repeats(sliding_window_view(data, length)[spot[twice]])
        least = np.minimum.reduceat(low[owner[order]], begins)
        later = order[low[owner[order]] > np.repeat(least, np.diff(np.append(begins, len(order))))]
        np.bitwise_or.at(mask, owner[later], np.int64(1) << number[later])
    bits = np.where(ids > low[kind], -1, mask[kind])
    pick = np.flatnonzero(bits)
    return pick, bits[pick]


# --- spans --------------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """What each document that loses bytes has repeated: ``doc_id, key, copied, judged``.

    ``copied`` lists starts of stretches that are repeats throughout, ``judged`` names of contexts with
    the windows that are repeats (all where ``bits`` is null). ``key`` is a hash of the text, which
    tells apart rows that repeat an id.
    """
    if not STEP <= gram < length <= gram + 62:
        raise ValueError("a context's windows must fit into one mask")
    spark = docs.sparkSession
    texts = _keyed(docs).where(f"doc_id IS NOT NULL AND n_bytes >= {length}").drop("n_bytes")
    bare = texts.select("doc_id", "text")

    stretched = cut(texts.mapInArrow(
        _stretched(length, gram), "doc_id long, key long, h1 long, h2 long, start long"), "stretched")
    first = cut(stretched.groupBy("h1", "h2").agg(F.min("doc_id").alias("low")), "first")
    both = stretched.join(first, ["h1", "h2"])
    copied = cut(both.where("doc_id > low").groupBy("doc_id", "key").agg(
        F.collect_list("start").alias("copied")), "copied")
    firsts = cut(both.where("doc_id = low").groupBy("doc_id").agg(F.collect_set("start").alias("firsts")), "firsts")
    discard(stretched, first)
    release(spark)

    wanted = cut(
        bare.mapInArrow(_anchored(length, gram), "anchor long, stretch long, doc_id long")
        .repartition("anchor").sortWithinPartitions("anchor", "stretch", "doc_id")
        .mapInArrow(_shared, "anchor long, doc_id long")
        .groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors")).join(firsts, "doc_id"), "wanted")
    discard(firsts)
    release(spark)
    settled = cut(
        bare.join(wanted.hint("merge"), "doc_id").select("doc_id", "text", "anchors", "firsts")
        .mapInArrow(_contexts(length, gram), CONTEXT)
        .repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_judged(length, gram, crowd), SETTLED), "settled")
    discard(wanted)
    release(spark)
    found = settled.where("context IS NULL").select("doc_id", "d1", "d2", "bits")
    crowded = settled.where("context IS NOT NULL").drop("bits")
    if not crowded.isEmpty():
        found = found.unionByName(_crowded_hits(crowded, length, gram))
    hits = cut(found.groupBy("doc_id").agg(F.collect_set(F.struct("d1", "d2", "bits").alias("hit")).alias("judged")), "hits")
    discard(settled)
    release(spark)
    keys = texts.select("doc_id", "key").distinct()
    return keys.join(copied, ["doc_id", "key"], "left").join(hits, "doc_id", "left").where(
        "copied IS NOT NULL OR judged IS NOT NULL")


def _crowded_hits(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows ``doc_id, d1, d2, bits`` as ``_judged`` gives them, of anchors with too many contexts for one task."""
    spark = contexts.sparkSession
    name = ["d1", "d2"]
    classes = cut(contexts.groupBy("anchor", *name).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")), "classes")
    several = cut(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "several")
    rivals = cut(
        contexts.select("anchor", *name, "lead", "context", "doc_id").join(several, "anchor")
        .groupBy(*name, "lead", "context").agg(F.min("doc_id").alias("low")), "rivals")
    release(spark)
    sides = cut(rivals.select(*name, "lead", "context").mapInArrow(
        _sides(length, gram), "s1 long, s2 long, d1 long, d2 long, side int"), "sides")
    met = cut(sides.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s1", "s2"), "met")
    open_sides = sides.join(met, ["s1", "s2"]).groupBy(*name).agg(
        F.expr("bit_or(shiftleft(1, side))").alias("sides"))
    open_ = cut(rivals.join(open_sides, name).withColumn("id", F.monotonically_increasing_id()), "open")
    discard(rivals, sides, met, several)
    release(spark)
    earliest = cut(
        open_.select("lead", "context", "sides", "low").mapInArrow(
            _block_repeats(length, gram), "w1 long, w2 long, low long, high long")
        .groupBy("w1", "w2").agg(F.min("low").alias("earliest"), F.max("high").alias("high"))
        .where("earliest != high").select("w1", "w2", "earliest"), "earliest")
    release(spark)
    masks = cut(
        open_.select("lead", "context", "sides", "low", "id").mapInArrow(
            _named_windows(length, gram), "w1 long, w2 long, id long, low long, number int")
        .join(earliest, ["w1", "w2"]).where("earliest < low")
        .groupBy("id").agg(F.expr("bit_or(shiftleft(1L, number))").alias("mask")), "masks")
    release(spark)
    masks = open_.select("id", *name).join(masks, "id").select(*name, "mask")
    judged = cut(classes.join(masks, name, "left").where("low != high OR mask IS NOT NULL")
                 .select(*name, "low", "mask"), "judged")
    discard(classes, open_, earliest)
    release(spark)
    return contexts.select(*name, "doc_id").join(judged, name).where("doc_id > low OR mask IS NOT NULL").select(
        "doc_id", *name, F.when(F.col("doc_id") == F.col("low"), F.col("mask")).alias("bits"))


def removed(texts: list[bytes], copied: list, judged: list, length: int, gram: int) -> tuple[list, list]:
    """Starts and stops of the maximal removed runs of each text."""
    starts: list[list[int]] = [[] for _ in texts]
    stops: list[list[int]] = [[] for _ in texts]
    hit = [i for i in range(len(texts)) if copied[i] or judged[i]]
    if hit:
        found = _removed(*[[x[i] for i in hit] for x in (texts, copied, judged)], length, gram)
        for i, start, stop in zip(hit, *found, strict=True):
            starts[i], stops[i] = start, stop
    return starts, stops


def _removed(texts: list[bytes], copied: list, judged: list, length: int, gram: int) -> tuple[list, list]:
    zero = _starts(texts)
    copies = _marks([c or [] for c in copied], zero)
    owner = np.concatenate([np.full(len(j or ()), i) for i, j in enumerate(judged)] or [zero]).astype(np.int64)
    flat = [h for j in judged for h in j or ()]
    d1, d2 = (np.array([h[k] for h in flat], np.int64) for k in ("d1", "d2"))
    bits = np.array([-1 if h["bits"] is None else h["bits"] for h in flat], np.int64)
    mark = _mark(d1, d2, owner)
    order = np.argsort(mark)
    mark, bits = mark[order], bits[order]
    spots = [np.zeros(0, np.int64)]
    for s in scan(texts, length, gram):
        whole = _found(s.stretches()[0] + s.base, copies)[s.stretch]
        d1, d2 = _context_names(s, np.arange(len(s.hashes)), length)
        own = _mark(d1, d2, s.text)
        at = np.searchsorted(mark, own)
        at[at == len(mark)] = 0
        mask = np.where(mark[at] == own, bits[at], 0) if len(mark) else np.zeros(len(own), np.int64)
        mask[whole] = -1
        hit = np.flatnonzero(mask)
        count = s.last[hit] - s.first[hit] + 1
        which = np.repeat(hit, count)
        number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        spots.append((s.first[which] + number + s.base)[mask[which] >> number & 1 > 0])
    spot = np.unique(np.concatenate(spots))
    text = np.searchsorted(zero, spot, side="right") - 1
    new = np.flatnonzero(np.append(True, (np.diff(spot) > length) | (np.diff(text) > 0)))[: len(spot)]
    text, start = text[new], spot[new]
    stop = spot[np.append(new[1:], len(spot)) - 1] + length if len(spot) else start
    split = np.searchsorted(text, np.arange(len(texts) + 1))
    return tuple(
        [(x[a:b] - z).tolist() for a, b, z in zip(split, split[1:], zero, strict=False)] for x in (start, stop))


def _kept(text: bytes, starts: list[int] | None, stops: list[int] | None) -> bytes:
    if not starts:
        return text
    return b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True))


def _digested(length: int, gram: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = raw_bytes(batch.column("text"))
            starts, stops = removed(
                texts, batch.column("copied").to_pylist(), batch.column("judged").to_pylist(), length, gram)
            kept = [_kept(*x) for x in zip(texts, starts, stops, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_bytes"),
                pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                pa.array([len(s) for s in starts], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    joined = _keyed(docs).join(
        cut(repeats(docs, length, gram, crowd), "repeats").hint("merge"), ["doc_id", "key"], "left")
    return joined.select("doc_id", "n_bytes", "text", "copied", "judged").mapInArrow(
        _digested(length, gram),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _shortened(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            data = [(t or "").encode() for t in texts]
            starts, stops = removed(
                data, batch.column("_copied").to_pylist(), batch.column("_judged").to_pylist(), length, gram)
            kept = [_kept(d, a, b).decode("utf-8", "ignore") if a else t
                    for t, d, a, b in zip(texts, data, starts, stops, strict=True)]
            at = batch.schema.get_field_index("text")
            changed = batch.set_column(at, batch.schema.field(at), pa.array(kept, batch.schema.field(at).type))
            yield changed.drop_columns(["_copied", "_judged"])

    return run


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``; a character cut in two goes as a whole.

    Rows that lose nothing are left as they are, also null texts; all columns stay.
    """
    found = cut(repeats(docs, length, gram).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"),
        F.col("copied").alias("_copied"), F.col("judged").alias("_judged")), "repeats")
    rows = docs.withColumns({
        "_id": F.col("doc_id").cast("long"), "_key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    joined = rows.join(found.hint("merge"), ["_id", "_key"], "left").select(*docs.columns, "_copied", "_judged")
    return joined.mapInArrow(_shortened(length, gram), docs.schema)
