"""Quality classifier by co-training of two views of a document.

The first view is the text: hashed words and figures of its form. The second is the metadata: language,
source and length, never the text. Each view has a logistic classifier in numpy. Over several
rounds each one scores all unlabelled documents and hands those it is surest of, good and bad
in the share of the labels, to the other as pseudo-labels. Both are then calibrated (Platt) on
labelled rows neither was trained on, their log odds are added over the prior, and all documents are scored.

Every text is read once: its features, a row of fixed size, are written to the shared folder. A round is a
scan of that table in which every task keeps its surest rows, and the surest of those are merged. The
models have a fixed size and travel with the tasks.

Bounds of the fitting set: ``fit_rows`` labelled documents, taken by a hash of the id, and ``pool_rows``
pseudo-labelled ones for each view, a share of ``handed`` of the unlabelled documents in each round at most. They
are chosen among all unlabelled documents, the surest first (then by a hash of the features). Documents with equal
features count once, so a large group of copies does not fill the set, and none is handed to a view twice.

Nulls: a null text is empty; null metadata is a value of its own. Labels that are null or contradict each
other for one id are not used; labels without a document neither; rows without an id are unlabelled. With
rows of one class only, every score is that class's share (0.5 without any). Repeated documents are scored each. Very
long texts are read whole, one at a time. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.llm.common import cut, discard, small_batches
from remitmatch.llm.toxicity import platt

FIT_ROWS, POOL_ROWS = 20_000, 4_000
WORDS, FORM, LANGS, SOURCES, SIZES = 256, 20, 16, 64, 24
# A document's features as stored: word shares in half precision, figures of form, three cells.
ROW = np.dtype([("words", "<f2", WORDS), ("form", "<f4", FORM), ("cells", "u1", 3)])
VIEWS = ("text", "page")


def text_features(text: str | None) -> np.ndarray:
    """Hashed word shares (square roots, signed) and figures of form."""
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    hashed = np.zeros(WORDS, np.float32)
    for word, count in counts.items():
        code = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        hashed[code % WORDS] += (1 if code >> 31 else -1) * (count / n) ** 0.5
    lines = text.split("\n")
    letters = sum(map(str.isalpha, text))
    digits = sum(map(str.isdigit, text))
    upper = sum(map(str.isupper, text))
    spaces = sum(map(str.isspace, text))
    marks = chars - letters - digits - spaces
    ends = sum(text.count(c) for c in ".!?")
    form = [
        letters / chars, digits / chars, upper / chars, spaces / chars, marks / chars,
        ends / n, text.count(",") / n, text.count("|") / n,
        sum(text.count(c) for c in "#$%&*@") / n, text.count("!") / n,
        len(counts) / n, max(counts.values(), default=0) / n, np.log1p(len(words)) / 10,
        sum(map(len, counts)) / max(1, len(counts)) / 10, letters / n / 10,
        len(set(lines)) / len(lines), np.log1p(len(lines)) / 10, len(words) / len(lines) / 100,
        sum(w[0].isupper() for w in counts) / max(1, len(counts)),
        sum(len(w) == 1 for w in counts) / max(1, len(counts)),
    ]
    return np.concatenate([hashed, np.array(form, np.float32)])


def page_cells(lang: str | None, source: str | None, n_chars: int | None) -> tuple[int, int, int]:
    """The cells of language, source and length, each of a fixed number of cells."""
    size = 0 if n_chars is None or n_chars < 0 else 1 + int(min(SIZES - 2, 1.5 * np.log1p(n_chars)))
    return zlib.crc32((lang or "").encode()) % LANGS, zlib.crc32((source or "").encode()) % SOURCES, size


def unpacked(rows: np.ndarray) -> dict[str, np.ndarray]:
    """Both views of stored rows; the cells become one column each."""
    text = np.concatenate([rows["words"].astype(np.float32), rows["form"]], axis=1)
    page = np.zeros((len(rows), LANGS + SOURCES + SIZES), np.float32)
    for cell, base in zip(rows["cells"].T.astype(np.int64), (0, LANGS, LANGS + SOURCES), strict=True):
        page[np.arange(len(rows)), base + cell] = 1
    return {"text": text, "page": page}


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ROW)


class Logistic:
    """Logistic regression on standardised features, by full-batch Adam on the log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 200):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        share = np.clip((weights * y).sum() / weights.sum(), 1e-3, 1 - 1e-3)
        self.w, self.b = np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
        first, second = np.zeros(len(self.w) + 1), np.zeros(len(self.w) + 1)
        weights = weights / weights.sum()
        for step in range(1, rounds + 1):
            miss = weights * (1 / (1 + np.exp(-np.clip(z @ self.w + self.b, -30, 30))) - y)
            g = np.append(z.T @ miss + 1e-3 * self.w, miss.sum())
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            self.w -= move[:-1]
            self.b -= float(move[-1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w + self.b


class Combined:
    """Both views with their calibration; without classifiers a constant share."""

    def __init__(self, share: float, text: Logistic | None = None, page: Logistic | None = None):
        self.share, self.text, self.page = share, text, page
        self.text_scale = self.page_scale = (1.0, 0.0)

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated scores of the text view, the metadata view and both."""
        if self.text is None or self.page is None:
            same = np.full(len(text), self.share)
            return same, same, same
        prior = np.log(self.share / (1 - self.share))
        one = self.text_scale[0] * self.text.logits(text) + self.text_scale[1]
        two = self.page_scale[0] * self.page.logits(page) + self.page_scale[1]
        return tuple(1 / (1 + np.exp(-np.clip(v, -40, 40))) for v in (one, two, one + two - prior))


def _exchange(own: dict[str, np.ndarray], marks: np.ndarray, rounds: int, surest) -> Combined:
    """Co-training on the labelled rows ``own``; ``marks``: 1 good, 0 bad.

    ``surest(models, share)`` gives, for each view, the rows of that view that the other one is surest of
    in this round, with its guesses.
    """
    check = np.zeros(len(marks), bool)
    for kind in (0, 1):
        check[np.flatnonzero(marks == kind)[::4]] = True
    seen = ~check if len(set(marks[~check])) == 2 else np.ones(len(marks), bool)
    share = float(marks.mean())
    taught = {view: (own[view][seen], marks[seen]) for view in VIEWS}

    def fitted(view: str) -> Logistic:
        x, y = taught[view]
        return Logistic(x, y, np.where(np.arange(len(y)) < seen.sum(), 1.0, 0.5))

    models = {view: fitted(view) for view in VIEWS}
    for _ in range(rounds):
        for view, (rows, guesses) in surest(models, share).items():
            x, y = taught[view]
            taught[view] = np.concatenate([x, rows]), np.concatenate([y, guesses])
        models = {view: fitted(view) for view in VIEWS}
    out = Combined(min(max(share, 1e-3), 1 - 1e-3), models["text"], models["page"])
    weights = np.ones(check.sum())
    out.text_scale = platt(models["text"].logits(own["text"][check]), marks[check], weights)
    out.page_scale = platt(models["page"].logits(own["page"][check]), marks[check], weights)
    return out


def _other(view: str) -> str:
    return VIEWS[1 - VIEWS.index(view)]


def cotrain(text: np.ndarray, page: np.ndarray, marks: np.ndarray, pool_text: np.ndarray,
            pool_page: np.ndarray, rounds: int, handed: float) -> Combined:
    """Co-training over a pool in memory. Each round hands over the share ``handed`` of the pool."""
    pool = {"text": pool_text, "page": pool_page}
    free = {view: np.ones(len(pool_text), bool) for view in VIEWS}

    def surest(models: dict[str, Logistic], share: float) -> dict:
        given = {}
        for view in VIEWS:
            other = _other(view)
            logits = models[view].logits(pool[view])
            order = np.argsort(logits, kind="stable")
            order = order[free[other][order]]
            bad = order[: int(handed * len(logits) * (1 - share))]
            good = order[len(order) - int(handed * len(logits) * share) :]
            bad, good = bad[logits[bad] < 0], good[logits[good] > 0]
            free[other][bad] = free[other][good] = False
            given[other] = (pool[other][np.concatenate([bad, good])],
                            np.concatenate([np.zeros(len(bad)), np.ones(len(good))]))
        return given

    return _exchange({"text": text, "page": page}, marks, rounds if len(pool_text) else 0, surest)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = np.zeros(batch.num_rows, ROW)
        pages = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")), strict=True)
        for i, (text, page) in enumerate(zip(batch.column("text"), pages, strict=True)):
            features = text_features(text.as_py())
            rows[i] = features[:WORDS], features[WORDS:], page_cells(*page)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "features"])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = unpacked(_rows(batch.column("features")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(s) for s in model.value.scores(views["text"], views["page"])]],
                ["doc_id", "text_score", "page_score", "score"])

    return run


def _first(rank: np.ndarray, keys: np.ndarray, features: np.ndarray, size: int) -> tuple:
    """The ``size`` rows of lowest rank (then key), one of each key."""
    order = np.lexsort((keys, rank))
    _, one = np.unique(keys[order], return_index=True)
    chosen = order[np.sort(one)][:size]
    return rank[chosen], keys[chosen], features[chosen]


def _surest(models: dict[str, Logistic], taken: dict[str, np.ndarray], sizes: tuple[int, int]):
    """Of a task's rows those each view is surest of: ``sizes`` bad and good ones, none already handed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for batch in batches:
            rows, keys = _rows(batch.column("features")), batch.column("key").to_numpy()
            views = unpacked(rows)
            for number, view in enumerate(VIEWS):
                logits = models[view].logits(views[view])
                fresh = ~np.isin(keys, taken[_other(view)])
                for kind, size in enumerate(sizes):
                    rank = -logits if kind else logits
                    at = np.flatnonzero(fresh & (rank < 0))
                    found = rank[at], keys[at], rows[at]
                    if (number, kind) in best:
                        found = tuple(map(np.concatenate, zip(best[number, kind], found, strict=True)))
                    best[number, kind] = _first(*found, size)
        for (number, kind), (rank, keys, rows) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rank), number, np.int32)), pa.array(np.full(len(rank), kind, np.int32)),
                 pa.array(rank.astype(np.float64)), pa.array(keys),
                 pa.array([r.tobytes() for r in rows], pa.binary())],
                ["view", "kind", "rank", "key", "features"])

    return run


def _handed(pool: DataFrame, models: dict[str, Logistic], taken: dict[str, np.ndarray], sizes: tuple[int, int]) -> dict:
    """For each view the stored rows that the other one is surest of, with its guesses; notes them in ``taken``."""
    best = cut(pool.mapInArrow(
        _surest(models, taken, sizes), "view int, kind int, rank double, key long, features binary"), "surest")
    given = {}
    for number, view in enumerate(VIEWS):
        other, rows, guesses = _other(view), [], []
        for kind, size in enumerate(sizes):
            part = best.where((F.col("view") == number) & (F.col("kind") == kind)).drop("view", "kind")
            found = part.dropDuplicates(["key"]).orderBy("rank", "key").limit(size).toPandas()
            rows += list(found["features"])
            guesses += [kind] * len(found)
            taken[other] = np.union1d(taken[other], found["key"].to_numpy(np.int64))
        given[other] = np.frombuffer(b"".join(rows), ROW), np.array(guesses, np.float64)
    discard(best)
    return given


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))


def featured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's ``doc_id, features, key, mark`` (null where unlabelled), from files; texts are read once.

    Only the rows of fixed size are shuffled for the labels; rows without an id stay where they are.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("mark"))
        .where("doc_id IS NOT NULL AND mark IN (0, 1)").groupBy("doc_id")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("high")).where("mark = high").drop("high")
    )
    rows = cut(_columns(docs).mapInArrow(_featured, "doc_id long, features binary")
               .withColumn("key", F.xxhash64("features")), "rows")
    known = rows.where("doc_id IS NOT NULL").join(marked, "doc_id", "left")
    return cut(known.unionByName(rows.where("doc_id IS NULL").withColumn("mark", F.lit(None).cast("int"))), "featured")


def fit(rows: DataFrame, fit_rows: int, pool_rows: int, rounds: int, handed: float, seed: int) -> Combined:
    """The model of the rows that ``featured`` gives."""
    chosen = (
        rows.where("mark IS NOT NULL").groupBy("doc_id").agg(F.min("key").alias("key"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(fit_rows)
    )
    found = rows.where("mark IS NOT NULL").join(F.broadcast(cut(chosen, "chosen")), ["doc_id", "key"]).select(
        "doc_id", "mark", "features").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    marks = found["mark"].to_numpy(np.float64)
    if len(set(marks)) < 2:
        return Combined(float(marks.mean()) if len(marks) else 0.5)
    pool = rows.where("mark IS NULL").select("key", "features")
    each = min(handed * pool.count(), pool_rows / max(1, rounds))
    taken = {view: np.zeros(0, np.int64) for view in VIEWS}

    def surest(models: dict[str, Logistic], share: float) -> dict:
        sizes = int(each * (1 - share)), int(each * share)
        return {view: (unpacked(stored)[view], guesses)
                for view, (stored, guesses) in _handed(pool, models, taken, sizes).items()}

    return _exchange(unpacked(np.frombuffer(b"".join(found["features"]), ROW)), marks, rounds if each else 0, surest)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fit_rows: int = FIT_ROWS,
                   pool_rows: int = POOL_ROWS, rounds: int = 4, handed: float = 0.05, seed: int = 3) -> DataFrame:
    """Per document ``doc_id, text_score, page_score, score, kept`` (scores: likelier good)."""
    rows = featured(docs, labels)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, fit_rows, pool_rows, rounds, handed, seed))
    return rows.select("doc_id", "features").mapInArrow(
        _scored(model), "doc_id long, text_score double, page_score double, score double"
    ).withColumn("kept", F.col("score") >= threshold)
