"""Toxicity scores by a convolutional text classifier, trained in numpy.

A word's embedding is the mean of hashed vectors for the word and its prefixes. Filters of several
widths slide over the words of the whole text; each keeps its largest answer (max pooling), and a
logistic layer on top gives a score, calibrated (Platt) on rows the training has not seen. For
every language a threshold is chosen on those same rows; the language is no input of the score.

Training reads every labelled row that is not held out, whole. The texts are cut into bucket numbers where they are
read. Up to ``shard_rows`` rows are trained on in one task. More are dealt by a hash of the id into shards of about
that size, where they meet their labels; a bit map of the labelled ids keeps most other texts out of that shuffle. In every epoch each shard goes on from the common network, and the weighted mean of the shards'
networks, formed part by part, is the next one. Calibration and thresholds count every fifth row of each shard and class; their
logits are counted in bins of 1 / ``FINE``. The model has a fixed size, whatever the input, and is broadcast; the driver gets
the model and the bins only. Scoring is one pass over the documents without a shuffle; long texts are worked
through in overlapping blocks.

Nulls: a null text is empty; an empty text gets the score of a text without any word. A null or
unknown language has the threshold of all languages. A label that is null, or whose document is
missing, is not used; a language with fewer than five toxic rows among those has the threshold of all languages; labels that contradict each other for one id count as toxic. With rows of one
class only, every score is that class's share. Repeated documents are scored each. Empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import cut, discard, give_back, mix, small_batches

BUCKETS, DIM, CHANNELS, WIDTHS = 1 << 16, 16, 12, (1, 2, 3)
SHORTEST, LONGEST = 3, 8  # prefixes
PIECES = LONGEST - SHORTEST + 2
_WORD = re.compile(r"\w+")
_OFFSETS = sum(WIDTHS)
_BLOCK = 1 << 15
FINE, PARTS = 256, 64  # bins of a unit of the logit; pieces in which networks are averaged
MAP_BITS = 1 << 25  # of the map of labelled ids; its size is fixed
_CHUNK = 1 << 12  # rows of the embedding updated at a time, words whose vectors are summed at a time
SHARD = "n long, sizes binary, numbers binary, words binary, marks binary, langs array<string>"
_CRC = np.array([zlib.crc32(bytes([i ^ 0xFF])) ^ 0xFF000000 for i in range(256)], dtype=np.uint32)  # step by a byte


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def pieces(word: str) -> list[int]:
    """Buckets of a word and its prefixes, always the same number (short words repeat)."""
    own = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
    return [own] + [
        zlib.crc32(b"^" + word[:k].encode("utf-8", "surrogatepass")) % BUCKETS if len(word) >= k else own
        for k in range(SHORTEST, LONGEST + 1)
    ]


def all_pieces(words: list[str]) -> np.ndarray:
    """``pieces`` of many words: their checksums are worked out side by side, byte by byte."""
    coded = [word.encode("utf-8", "surrogatepass") for word in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    own = np.fromiter(map(zlib.crc32, coded), np.int64, len(coded)) % BUCKETS
    out = np.repeat(own[:, None], PIECES, axis=1).astype(np.int32)
    plain = sizes == np.fromiter(map(len, words), np.int64, len(words))
    for rows, width in ((np.flatnonzero(plain), LONGEST), (np.flatnonzero(~plain), 4 * LONGEST)):
        heads = np.zeros((len(rows), width + 1), dtype=np.uint8)
        heads[:, :width] = np.array([coded[i] for i in rows], dtype=f"S{width}").view(np.uint8).reshape(-1, width)
        begins = (heads & 0xC0) != 0x80  # also past the end
        crc = np.full(len(rows), zlib.crc32(b"^") ^ 0xFFFFFFFF, dtype=np.uint32)
        letters = np.zeros(len(rows), dtype=np.int64)
        for at in range(width):
            crc = _CRC[(crc ^ heads[:, at]) & 0xFF] ^ (crc >> 8)
            letters += begins[:, at]
            whole = np.flatnonzero(
                (sizes[rows] > at) & begins[:, at + 1] & (letters >= SHORTEST) & (letters <= LONGEST))
            out[rows[whole], letters[whole] - SHORTEST + 1] = (crc[whole] ^ 0xFFFFFFFF) % BUCKETS
    return out


class _Numbers(dict):
    """Number of each word, given when the word is first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self) + 1
        return number


class Vocabulary:
    """Numbers words as they come; number 0 is the padding after a text."""

    def __init__(self) -> None:
        self.index = _Numbers()

    @property
    def buckets(self) -> np.ndarray:
        words = list(self.index)
        parts = [all_pieces(words[low : low + _CHUNK]) for low in range(0, len(words), _CHUNK)]
        return np.concatenate([np.zeros((1, PIECES), dtype=np.int32), *parts])

    def numbers(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        out = np.zeros(len(words) + max(WIDTHS) - 1 + (not words), dtype=np.int32)
        out[: len(words)] = np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))
        return out


class Network:
    """Embeddings, filters of all widths, a logistic layer and the calibration."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.filters = rng.normal(0, 0.3, (_OFFSETS, DIM, CHANNELS)).astype(np.float32)
        self.bias = np.zeros((len(WIDTHS), CHANNELS), dtype=np.float32)
        self.top = rng.normal(0, 0.3, (len(WIDTHS), CHANNELS)).astype(np.float32)
        self.shift = np.zeros(1, dtype=np.float32)
        self.calibration = (1.0, 0.0)
        self.constant: float | None = None

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.top, self.shift]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for w in self.weights():
            w[...] = flat[at : at + w.size].reshape(w.shape)
            at += w.size

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        out = np.empty((len(buckets), DIM), dtype=np.float32)
        for low in range(0, len(buckets), _CHUNK):
            part, total = buckets[low : low + _CHUNK], out[low : low + _CHUNK]
            total[...] = self.embedding[part[:, 0]]
            for k in range(1, part.shape[1]):
                total += self.embedding[part[:, k]]
            total /= np.float32(part.shape[1])
        return out

    def answers(self, vectors: np.ndarray, first_is_padding: bool = True) -> np.ndarray:
        """What each word adds to each filter at each offset, (words, offsets, channels)."""
        flat = self.filters.transpose(1, 0, 2).reshape(DIM, -1)
        out = (vectors @ flat).reshape(len(vectors), _OFFSETS, CHANNELS)
        if first_is_padding:
            out[0] = 0
        return out

    @staticmethod
    def pooled(answers: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter over the text, and where it begins."""
        best = np.full((len(WIDTHS), CHANNELS), -np.inf, dtype=np.float32)
        where = np.zeros((len(WIDTHS), CHANNELS), dtype=np.int64)
        reach = max(WIDTHS) - 1
        for start in range(0, max(1, len(numbers) - reach), _BLOCK):
            part = answers[numbers[start : start + _BLOCK + reach]]
            n, offset = len(part) - reach, 0
            for w, width in enumerate(WIDTHS):
                total = part[:n, offset]
                for k in range(1, width):
                    total = total + part[k : n + k, offset + k]
                offset += width
                at = total.argmax(axis=0)
                top = total[at, np.arange(CHANNELS)]
                better = top > best[w]
                best[w][better] = top[better]
                where[w][better] = at[better] + start
        return best, where

    @staticmethod
    def highest(answers: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Largest answer of each filter over the text, as ``pooled`` gives it."""
        best = np.full((len(WIDTHS), CHANNELS), -np.inf, dtype=np.float32)
        reach = max(WIDTHS) - 1
        for start in range(0, max(1, len(numbers) - reach), _BLOCK):
            part = answers[numbers[start : start + _BLOCK + reach]]
            n, offset = len(part) - reach, 0
            for w, width in enumerate(WIDTHS):
                total = part[:n, offset]
                for k in range(1, width):
                    total = total + part[k : n + k, offset + k]
                offset += width
                np.maximum(best[w], total.max(axis=0), out=best[w])
        return best

    def logit(self, best: np.ndarray) -> float:
        return float((np.maximum(best + self.bias, 0) * self.top).sum() + self.shift[0])

    def score(self, logit):
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * np.asarray(logit, dtype=np.float64) + b, -40, 40)))


def train(texts: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, seed: int,
          epochs: int, batch: int = 48, rate: float = 0.01, least_steps: int = 300,
          start: np.ndarray | None = None) -> Network:
    """Adam on the log loss; gradients reach only the words that won a filter's pooling.

    Few texts are gone through more often, until ``least_steps`` steps are made. Training goes on from the
    weights ``start``, if given.
    """
    epochs = max(epochs, -(-least_steps * batch // len(texts)))
    net, rng = Network(seed), np.random.default_rng(seed)
    if start is not None:
        net.load(start)
    params = net.weights()
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    slopes = np.zeros_like(net.embedding)
    place = np.zeros(len(buckets), dtype=np.int64)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            every = np.concatenate([[0], *[texts[i] for i in chosen]])
            seen = np.zeros(len(buckets), dtype=bool)
            seen[every] = True
            used = np.flatnonzero(seen)
            place[used] = np.arange(len(used))
            local = place[every]
            vectors = net.vectors(buckets[used])
            answers = net.answers(vectors)
            grads = [slopes, *(np.zeros_like(p) for p in params[1:])]
            touched = np.zeros(0, dtype=np.int64)
            words, word_grads = [], []
            at = 1
            for i in chosen:
                numbers = local[at : at + len(texts[i])]
                at += len(texts[i])
                best, where = net.pooled(answers, numbers)
                hidden = best + net.bias
                miss = (1 / (1 + np.exp(-np.clip(net.logit(best), -30, 30))) - labels[i]) / len(chosen)
                grads[3] += miss * np.maximum(hidden, 0)
                grads[4] += miss
                back = np.where(hidden > 0, miss * net.top, 0).astype(np.float32)
                grads[2] += back
                offset = 0
                for w, width in enumerate(WIDTHS):
                    live = np.flatnonzero(back[w])
                    for k in range(width):
                        hit = numbers[where[w][live] + k]
                        real = hit > 0
                        c, hit_words = live[real], hit[real]
                        grads[1][offset + k].T[c] += back[w][c][:, None] * vectors[hit_words]
                        words.append(hit_words)
                        word_grads.append(back[w][c][:, None] * net.filters[offset + k][:, c].T)
                    offset += width
            if words:
                hit_words = np.concatenate(words)
                spread = np.repeat(np.concatenate(word_grads) / PIECES, PIECES, axis=0)
                touched = buckets[used[hit_words]].reshape(-1)
                np.add.at(slopes, touched, spread)
            step += 1
            for arrays in zip(params, grads, first, second, strict=True):
                for row in range(0, len(arrays[0]), _CHUNK):
                    _adam(*(a[row : row + _CHUNK] for a in arrays), rate, step)
            slopes[touched] = 0
    return net


def _adam(p: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float, step: int) -> None:
    """One step of Adam in place, on as many rows as the processor's cache holds."""
    change = g - m
    change *= 0.1
    m += change
    np.multiply(g, g, out=change)
    change -= v
    change *= 0.001
    v += change
    np.divide(v, 1 - 0.999**step, out=change)
    np.sqrt(change, out=change)
    change += 1e-7
    move = m / (1 - 0.9**step)
    move *= rate
    move /= change
    p -= move


def platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift that fit the weighted log loss, by Newton's rounds with a small prior."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        g = np.array([(weights * (p - labels) * logits).sum() + 1e-2 * (a - 1),
                      (weights * (p - labels)).sum() + 1e-3 * b])
        s = weights * p * (1 - p)
        h = np.array([[(s * logits**2).sum() + 1e-2, (s * logits).sum()],
                      [(s * logits).sum(), s.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def best_threshold(scores: np.ndarray, labels: np.ndarray, default: float) -> float:
    """The score from which flagging has the best F1; the default where a class is missing."""
    if not 0 < labels.sum() < len(labels):
        return default
    return _cut_at_best(scores, labels, np.ones(len(scores)))


def _cut_at_best(scores: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """The same over scores that stand for ``rows`` rows, ``toxic`` of them with label 1."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.cumsum(rows[order]) + toxic.sum())
    top = int(f1.argmax())
    below = scores[order[top + 1]] if top + 1 < len(order) else 0.0
    return float((scores[order[top]] + below) / 2)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of their own words, and the buckets of those words (16 bits each)."""
    for batch in small_batches(batches, "text", 2 << 20):
        numbers, words = [], []
        for text in batch.column("text").to_pylist():
            vocabulary = Vocabulary()
            numbers.append(vocabulary.numbers(text).astype("<u4").tobytes())
            words.append(vocabulary.buckets.astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "toxic", "lang")] + [pa.array(numbers, pa.binary()), pa.array(words, pa.binary())],
            ["doc_id", "toxic", "lang", "numbers", "words"])


def _joined(numbers: list[bytes], words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts in one numbering of words (0 stays the padding), and the buckets of each word."""
    own = [np.frombuffer(w, "<u2").reshape(-1, PIECES) for w in words]
    sizes = np.cumsum([0, *(len(w) for w in own)])
    rows = np.concatenate(own)
    padded = np.zeros((len(rows), -(-PIECES // 4) * 4), "<u2")
    padded[:, :PIECES] = rows
    halves = padded.view("<u8")
    spread = np.arange(1, 2 * halves.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = mix((mix(halves) * spread).sum(axis=1, dtype=np.uint64))
    keys[sizes[:-1]] = 0  # the padding, before all others
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    texts = [number[a:b].astype(np.int32)[np.frombuffer(n, "<u4")]
             for a, b, n in zip(sizes[:-1], sizes[1:], numbers, strict=True)]
    return texts, rows[first].astype(np.int32)


def fit(docs: DataFrame, labels: DataFrame, shard_rows: int, epochs: int, seed: int,
        threshold: float) -> tuple[Network, dict[str | None, float]]:
    """The network and the thresholds by language (None: all languages)."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 4 != 2")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    shares = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    found = None
    if total:
        place = F.xxhash64("doc_id", F.lit(seed))
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
        )
        if total > shard_rows and len(shares) == 2:
            shard = F.pmod(place, F.lit(-(-total // shard_rows)))
            near = _perhaps_in(marked, rows).withColumns({"place": place, "shard": shard})
            return _fit_in_shards(near, marked.withColumn("shard", shard), epochs, seed, threshold)
        ordered = (
            rows.join(marked, "doc_id").mapInArrow(_numbered, "doc_id long, toxic int, lang string, numbers binary, words binary")
            .dropDuplicates(["doc_id"]).orderBy(place, "doc_id").limit(total).drop("doc_id")
        )
        found = ordered.mapInArrow(_trained(shares, epochs, seed, threshold), "model binary").first()
    if found is None:
        net = Network(seed)
        net.constant = shares.get(1, 0) / max(1, total)
        return net, {None: threshold}
    return pickle.loads(found["model"])


def _perhaps_in(marked: DataFrame, rows: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` without most of those whose id is not in ``marked``; none that is in it is left out.

    The ids' hashes are marked in a bit map of fixed size, which is broadcast, so that texts without a label are not
    shuffled. Where ids share a bit, too many rows stay; whoever joins them drops those.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    maps = marked.select(bit.alias("bit")).groupBy(F.expr("bit DIV 32768").alias("_map")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32768).alias("_bits"))
    is_set = "shiftright(CAST(conv(hex(substring(_bits, CAST(_bit % 32768 DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), "\
             "CAST(_bit % 8 AS INT)) & 1 = 1"
    return (
        rows.where("doc_id IS NOT NULL").withColumn("_bit", bit).withColumn("_map", F.expr("_bit DIV 32768"))
        .join(F.broadcast(maps), "_map").where(is_set).select(*rows.columns)
    )


def _aside(marks: np.ndarray) -> np.ndarray:
    """Every fifth row of each class: not trained on, but used for calibration and thresholds."""
    unseen = np.zeros(len(marks), dtype=bool)
    for kind in (0, 1):
        unseen[np.flatnonzero(marks == kind)[::5]] = True
    return unseen


def _fit_in_shards(rows: DataFrame, marked: DataFrame, epochs: int, seed: int,
                   threshold: float) -> tuple[Network, dict[str | None, float]]:
    """The network trained on all rows with a mark, shard by shard, and its thresholds by language."""
    shards = cut(
        rows.groupBy("shard").cogroup(marked.groupBy("shard")).applyInArrow(_packed, SHARD),
        "toxicity_shards")
    context = rows.sparkSession.sparkContext
    net = Network(seed)
    size = -(-len(net.flat()) // PARTS)
    for epoch in range(epochs):
        start = context.broadcast(net.flat())
        means = (
            shards.mapInArrow(_epoch(start, seed + epoch, size), "part int, weight double, piece binary")
            .groupBy("part").applyInArrow(_mean, "part int, piece binary")
        ).collect()  # one network
        pieces = [np.frombuffer(r["piece"], "<f4") for r in sorted(means, key=lambda r: r["part"])]
        if pieces:
            net.load(np.concatenate(pieces))
        start.unpersist()
    final = context.broadcast(net.flat())
    counts = (
        shards.mapInArrow(_bins(final, seed), "lang string, toxic int, bin int")
        .groupBy("lang", "bin").agg(F.sum(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
    )
    counts = cut(counts, "toxicity_bins")
    every = counts.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).orderBy("bin").toArrow()
    logits, n, toxic = ((every.column(c).to_numpy().astype(np.float64)) for c in ("bin", "n", "toxic"))
    logits = logits / FINE
    if toxic.sum():
        net.calibration = platt(
            np.concatenate([logits, logits]), np.repeat([1.0, 0.0], len(logits)),
            np.concatenate([toxic, n - toxic]) / n.sum() * len(logits))
    thresholds: dict[str | None, float] = {None: threshold}
    if 0 < toxic.sum() < n.sum():
        thresholds[None] = _cut_at_best(net.score(logits), toxic, n)
    own = counts.where("coalesce(lang, '') <> ''").groupBy("lang").applyInArrow(
        _threshold(net.calibration, threshold), "lang string, threshold double")
    thresholds |= {r["lang"]: r["threshold"] for r in own.collect()}
    discard(shards, counts)
    return net, thresholds


def _packed(rows: pa.Table, marked: pa.Table) -> pa.Table:
    """A shard as one row: its texts in numbers, buckets, labels and languages, by the ids' hash; one row per id.

    The rows are put in order by their places only, so that the texts are in memory once.
    """
    marked = marked.sort_by("doc_id")
    known = marked.column("doc_id").to_numpy()
    order = pc.sort_indices(rows, [(c, "ascending") for c in ("place", "doc_id", "text", "lang")]).to_numpy()
    ids = rows.column("doc_id").to_numpy()[order]
    at = np.searchsorted(known, ids)
    one = np.append(True, ids[1:] != ids[:-1])[: len(ids)]
    found = np.flatnonzero(one & (known[np.minimum(at, len(known) - 1)] == ids)) if len(known) else at[:0]
    if not len(found):
        return pa.table([[]] * 6, pa.schema([
            ("n", pa.int64()), *((c, pa.binary()) for c in ("sizes", "numbers", "words", "marks")),
            ("langs", pa.list_(pa.string()))]))
    marks = marked.column("toxic").to_numpy()[at[found]].astype(np.float64)
    vocabulary, column = Vocabulary(), rows.column("text")
    texts = [vocabulary.numbers(column[i].as_py()) for i in order[found].tolist()]
    spoken = rows.column("lang").take(pa.array(order[found])).combine_chunks().cast(pa.string())
    del rows, column
    sizes = np.array([len(x) for x in texts], dtype="<i8")
    numbers, words = np.concatenate(texts), vocabulary.buckets.astype("<u2")
    del texts, vocabulary
    give_back()
    spans = pa.array([0, len(spoken)], pa.int32())
    return pa.table({
        "n": [len(sizes)], "sizes": _one_value(sizes), "numbers": _one_value(numbers), "words": _one_value(words),
        "marks": _one_value(marks), "langs": pa.ListArray.from_arrays(spans, spoken)})


def _one_value(values: np.ndarray) -> pa.Array:
    """The array's bytes as one binary value, not copied."""
    ends = np.array([0, values.nbytes], dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _shards(batches: Iterator[pa.RecordBatch]):
    """Texts as numbers (views of the batch, not copies), buckets, labels and languages of each shard."""
    for batch in batches:
        for i in range(batch.num_rows):
            sizes, numbers, words, marks = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                for c, kind in (("sizes", "<i8"), ("numbers", "<i4"), ("words", "<u2"), ("marks", "<f8")))
            ends = np.cumsum(sizes).tolist()
            texts = [numbers[end - size : end] for end, size in zip(ends, sizes.tolist(), strict=True)]
            yield texts, words.reshape(-1, PIECES).astype(np.int32), marks, batch.column("langs")[i].as_py()


def _epoch(start, seed: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, buckets, marks, _ in _shards(batches):
            seen = np.flatnonzero(~_aside(marks))
            flat = start.value
            if len(seen):
                flat = train([texts[i] for i in seen], marks[seen], buckets, seed, 1, least_steps=0, start=flat).flat()
            pieces = [flat[k : k + size].astype("<f4").tobytes() for k in range(0, len(flat), size)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(range(len(pieces)), pa.int32()), "weight": pa.array([float(len(seen))] * len(pieces)),
                "piece": pa.array(pieces, pa.binary())})
            del texts, buckets, marks, flat, pieces
            give_back()

    return run


def _mean(table: pa.Table) -> pa.Table:
    """The mean of one piece of all networks, weighted by their rows."""
    weights = table.column("weight").to_numpy()
    total = np.zeros(len(table.column("piece")[0].as_py()) // 4)
    for weight, piece in zip(weights, table.column("piece"), strict=True):
        total += np.frombuffer(piece.as_py(), "<f4") * (weight / max(weights.sum(), 1.0))
    return pa.table({"part": table.column("part")[:1], "piece": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def _logits(net: Network, texts: list[np.ndarray], buckets: np.ndarray, rows: np.ndarray) -> list[float]:
    out = []
    for i in rows:
        used, local = np.unique(np.concatenate([[0], texts[i]]), return_inverse=True)
        out.append(net.logit(net.highest(net.answers(net.vectors(buckets[used])), local[1:])))
    return out


def _bins(final, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(seed)
        net.load(final.value)
        for texts, buckets, marks, spoken in _shards(batches):
            check = np.flatnonzero(_aside(marks))
            logits = np.clip(_logits(net, texts, buckets, check), -100, 100)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([spoken[i] for i in check], pa.string()),
                "toxic": pa.array(marks[check].astype(np.int32)),
                "bin": pa.array(np.round(logits * FINE).astype(np.int32))})
            del texts, buckets
            give_back()

    return run


def _threshold(calibration: tuple[float, float], threshold: float):
    def run(table: pa.Table) -> pa.Table:
        net = Network(0)
        net.calibration = calibration
        bins, n, toxic = (table.column(c).to_numpy().astype(np.float64) for c in ("bin", "n", "toxic"))
        if toxic.sum() < 5:
            return table.select(["lang"]).slice(0, 0).append_column("threshold", pa.array([], pa.float64()))
        best = _cut_at_best(net.score(bins / FINE), toxic, n) if toxic.sum() < n.sum() else threshold
        return table.select(["lang"]).slice(0, 1).append_column("threshold", pa.array([best], pa.float64()))

    return run


def _trained(shares: dict[int, int], epochs: int, seed: int, threshold: float):
    """The task that trains on the rows of one shard, in their order; no row where a class is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts and len(set().union(*(b.column("toxic").to_pylist() for b in parts))) == 2:
            model = pickle.dumps(_learned(pa.Table.from_batches(parts), shares, epochs, seed, threshold))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    return run


def _learned(rows: pa.Table, shares: dict[int, int], epochs: int, seed: int,
             threshold: float) -> tuple[Network, dict[str | None, float]]:
    """Train on four fifths of the rows, calibrate and choose thresholds on the rest."""
    marks = rows.column("toxic").to_numpy().astype(np.float64)
    spoken = rows.column("lang").to_pylist()
    texts, buckets = _joined(rows.column("numbers").to_pylist(), rows.column("words").to_pylist())
    del rows
    unseen = _aside(marks)
    seen = np.flatnonzero(~unseen)
    if len(set(marks[seen])) < 2:
        seen = np.arange(len(marks))
    net = train([texts[i] for i in seen], marks[seen], buckets, seed, epochs)
    check = np.flatnonzero(unseen)
    logits = _logits(net, texts, buckets, check)
    taken = {kind: max(1, int((marks == kind).sum())) for kind in (0, 1)}
    weights = np.array([shares[int(m)] / taken[int(m)] for m in marks[check]])
    net.calibration = platt(np.array(logits), marks[check], weights / weights.mean())
    scores = net.score(logits)
    thresholds: dict[str | None, float] = {None: best_threshold(scores, marks[check], threshold)}
    languages = np.array([spoken[i] or "" for i in check])
    for language in sorted(set(languages) - {""}):
        own = languages == language
        if (marks[check][own] == 1).sum() >= 5:
            thresholds[str(language)] = best_threshold(scores[own], marks[check][own], threshold)
    return net, thresholds


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network = model.value
        for batch in small_batches(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            if net.constant is not None:
                scores = [net.constant] * len(texts)
            else:
                vocabulary = Vocabulary()
                numbers = [vocabulary.numbers(t) for t in texts]
                answers = net.answers(net.vectors(vocabulary.buckets))
                scores = net.score([net.logit(net.highest(answers, n)) for n in numbers]).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(scores, pa.float64())],
                ["doc_id", "lang", "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, shard_rows: int = 8000,
                    epochs: int = 5, seed: int = 5) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted, lang_threshold, flagged``.

    ``predicted`` holds the score against ``threshold``, ``flagged`` against the threshold of the
    document's language. Rows whose ``crc32(doc_id) % 4`` is 2 are held out of the training.
    """
    net, thresholds = fit(docs, labels, shard_rows, epochs, seed, threshold)
    model = docs.sparkSession.sparkContext.broadcast(net)
    limit = F.lit(thresholds[None])
    for language, value in thresholds.items():
        if language is not None:
            limit = F.when(F.col("lang") == language, value).otherwise(limit)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_scored(model), "doc_id long, lang string, score double")
        .select(
            "doc_id",
            F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
            "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
            limit.alias("lang_threshold"))
        .withColumn("flagged", F.col("score") >= F.col("lang_threshold"))
    )


def _passed(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "lang"]
        for batch in small_batches(batches, "text", 2 << 20):
            bare = pa.RecordBatch.from_arrays([batch.column(c) for c in names], names)
            scores = np.concatenate(
                [s.column("score").to_numpy() for s in _scored(model)(iter([bare]))] or [np.zeros(0)])
            yield batch.filter(pa.array(scores < threshold))
        give_back()

    return run


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, shard_rows: int = 8000,
                 epochs: int = 5, seed: int = 5) -> DataFrame:
    """The documents of ``docs`` that score below ``threshold``, with all their columns.

    The threshold is the same in every language; those calibrated by language are not used here.
    """
    net, _ = fit(docs, labels, shard_rows, epochs, seed, threshold)
    model = docs.sparkSession.sparkContext.broadcast(net)
    return docs.mapInArrow(_passed(model, threshold), docs.schema)
