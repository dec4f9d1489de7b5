"""Near duplicates, repeated strings and embeddings against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from remitmatch.llm import minhash, pq, suffixes
from remitmatch.llm.common import components

WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "se", "mo") for b in ("n", "la", "x", "dde", "")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 140)]
    pairs += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(5, 5)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    ids = {i for p in pairs for i in p}
    want = reachable(ids, pairs)
    assert all(got.get(i, i) == want[i] for i in ids)
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


# --- MinHash ------------------------------------------------------------------------------


def shingle_sets(texts, width):
    out = {}
    for i, text in texts:
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        out[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    return out


def brute_near(texts, width, percent):
    sets = shingle_sets(texts, width)
    ids = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, reachable(ids, links)


def near_texts(seed, groups=6, copies=25):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randrange(1, 60)) for _ in range(40)]
    for _ in range(groups):
        base = sentence(rng, 80).split()
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                if rng.random() < 0.5:
                    words[rng.randrange(len(words))] = rng.choice(WORDS)
                else:
                    del words[rng.randrange(len(words))]
            texts.append(" ".join(words))
    texts += [texts[50].upper(), texts[51] + "  \n", "", None, "one", "one", "ONE", "a b", "a\x0bb", "a b"]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_brute_force(documents, rows, width):
    texts = near_texts(width)
    sets, want = brute_near(texts, width, 80)
    got = rows(minhash.near_duplicates(documents(texts, extra=True), width))
    assert len(got) == len(texts)
    for i, row in got.items():
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[i]), want[i], want[i] == i)


def test_near_duplicates_of_mixed_lengths_over_a_shared_passage(documents, rows):
    rng = random.Random(3)
    passage = sentence(rng, 60)
    hot = minhash.signature(minhash.shingles(passage.encode(), 5), 2, 7)
    texts = [passage] * 2
    for tail in (0, 4, 9, 20, 30, 45, 60, 80, 100, 130, 160):
        for _ in range(2):
            while True:  # one bucket holds them all, so only the comparison inside it decides
                words = sentence(rng, tail).split()
                copies = [" ".join([passage, *words[:k], "other", *words[k:]]) for k in (0, tail // 2, tail)]
                if all((minhash.signature(minhash.shingles(c.encode(), 5), 2, 7) == hot).all() for c in copies):
                    break
            texts += copies
    texts = list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))
    _, want = brute_near(texts, 5, 80)
    assert len(set(want.values())) > 10
    got = rows(minhash.near_duplicates(documents(texts), 5, bands=2, rows=1))
    assert {i: row["component_id"] for i, row in got.items()} == want


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_sizes_that_can_link_share_a_class(spark, percent):
    sizes = spark.range(1, 3000).select(F.col("id").alias("n"), minhash.size_classes(percent, "id").alias("both"))
    both = {r.n: set(r.both) for r in sizes.collect()}
    for n in both:
        largest = min(100 * n // percent, 2999)
        assert both[n] & both[largest]


def test_near_duplicates_odd_rows(documents, rows):
    text = "a b c d e f g h i j"
    got = rows(minhash.near_duplicates(documents([(3, text), (3, text), (None, text), (1, text), (2, None), (4, "")])))
    assert [r["component_id"] for r in got[3]] == [1, 1]
    assert got[None]["component_id"] is None and got[None]["kept"]
    assert got[2]["n_shingles"] == 0 and got[2]["kept"] and got[4]["kept"]
    assert minhash.near_duplicates(documents([])).count() == 0
    left = minhash.drop_near_duplicates(documents([(3, text), (1, text), (None, text), (2, None)], extra=True))
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 1, 2]


def test_long_text_signature_is_blockwise():
    values = np.arange(50_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = minhash.signature(values, 96, 7, block=1 << 20)
    assert (minhash.signature(values, 96, 7, block=1000) == whole).all()


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    two = np.concatenate([one[:1600], rng.integers(0, 1 << 63, 400, dtype=np.uint64)])
    a, b = (minhash.signature(np.unique(v), 512, 7) for v in (one, two))
    assert abs((a == b).mean() - 1600 / 2400) < 0.08


# --- repeated strings ---------------------------------------------------------------------


def brute_repeats(texts, length=50):
    earliest = {}
    data = [(i, (t or "").encode()) for i, t in texts]
    for i, d in data:
        if i is not None:
            for s in range(len(d) - length + 1):
                w = d[s : s + length]
                earliest[w] = min(earliest.get(w, i), i)
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        if i is not None:
            for s in range(len(d) - length + 1):
                if earliest[d[s : s + length]] < i:
                    gone[s : s + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_texts(seed):
    rng = random.Random(seed)
    shared = [sentence(rng, n) for n in (12, 20, 40)] + ["é" * 60, "ab" * 80, "z" * 300]
    texts = []
    for _ in range(60):
        parts = [sentence(rng, rng.randrange(0, 30)) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randrange(0, 12)
            parts.insert(rng.randrange(3), piece[cut : len(piece) - rng.randrange(0, 12)])
        texts.append("\n".join(parts))
    texts += [texts[3], texts[3], "", None, "short", "short", "x" * 49, "x" * 49, "x" * 50, "x" * 50, "x" * 51]
    texts.append("".join(rng.choice("ab") for _ in range(4000)) + texts[5])
    return list(zip(rng.sample(range(5000), len(texts)), texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(documents, seed):
    texts = repeat_texts(seed)
    got = suffixes.remove_repeats(documents(texts, extra=True)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_repeats(texts)


@pytest.mark.parametrize("crowd", [0, 400, 1 << 20])
def test_repeats_of_anchors_over_several_batches(spark, documents, crowd):
    """Anchors cut at batch borders, and anchors with too many contexts for one task."""
    texts = repeat_texts(3)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        got = suffixes.remove_repeats(documents(texts), crowd=crowd).collect()
    finally:
        spark.conf.set(name, rows)
    assert sorted([tuple(r) for r in got], key=str) == brute_repeats(texts)


def test_repeats_shuffle_anchors_once_and_no_windows(documents, monkeypatch):
    """Contexts meet by anchor and are judged there: windows are only shuffled for crowded anchors."""
    texts, plans = repeat_texts(4), {}
    monkeypatch.setattr(suffixes, "cut", lambda df, name, cut=suffixes.cut: plans.update(
        {name: df._jdf.queryExecution().executedPlan().toString()}) or cut(df, name))
    got = suffixes.remove_repeats(documents(texts)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_repeats(texts)
    assert not {"shared", "earliest", "masks"} & set(plans)
    assert plans["settled"].count("hashpartitioning(anchor") == plans["wanted"].count("hashpartitioning(anchor") == 1


def test_shared_anchors_do_not_depend_on_batches():
    rng = np.random.default_rng(5)
    rows = np.unique(rng.integers(0, (40, 4, 9), (400, 3)), axis=0)  # anchor, stretch, id, in this order
    first = {}
    for anchor, stretch, i in rows.tolist():
        first.setdefault(anchor, {}).setdefault(stretch, i)
    want = sorted((a, i) for a, found in first.items() if len(found) > 1 for i in found.values())
    for size in (1, 2, 7, 400):
        batches = [pa.record_batch([pa.array(c) for c in part.T], ["anchor", "stretch", "doc_id"])
                   for part in np.split(rows, range(size, len(rows), size))]
        got = [tuple(r.values()) for b in suffixes._shared(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == want


def test_repeats_odd_rows(documents, rows):
    line = "the same line of more than fifty bytes stands in all of these documents"
    texts = [(None, line), (2, line), (2, line), (5, line + " and more"), (2, line + "!"), (7, line)]
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(texts)).collect()], key=str)
    assert got == brute_repeats(texts)
    assert suffixes.remove_repeats(documents([])).count() == 0
    assert suffixes.cut_repeats(documents([])).count() == 0


def test_cut_repeats_keeps_rows_and_columns(documents, rows):
    line = "the same line of more than fifty bytes stands in all of these documents"
    df = documents([(1, line), (2, "before " + line + " after"), (3, line), (4, None), (None, line)], extra=True)
    left = suffixes.cut_repeats(df)
    assert left.columns == df.columns
    got = {r.doc_id: r.text for r in left.collect()}
    assert got == {1: line, 2: "before  after", 3: "", 4: None, None: line}


def test_blocks_do_not_change_anchors(monkeypatch):
    rng = random.Random(3)
    texts = [("a" * 120 + sentence(rng, 200)).encode(), b"", b"short", sentence(rng, 90).encode(), b"z" * 50]

    def named():
        return {(s.base + w, s.base + p, int(h), int(t)) for s in suffixes.scan(texts, 50, 16)
                for p, a, b, h, t in zip(s.place, s.first, s.last, s.hashes, s.text, strict=True)
                for w in range(a, b + 1)}

    whole = named()
    for block in (97, 300, 1000):
        monkeypatch.setattr(suffixes, "BLOCK", block)
        assert named() == whole
        zero = np.cumsum([0, *map(len, texts)])
        together = {(int(s.text[b]), int(s.base + f - zero[s.text[b]])) for s in suffixes.scan(texts, 50, 16)
                    for b, f in zip(s.begins, s.first[s.begins], strict=True)}
        alone = {(i, int(s.base + f)) for i, t in enumerate(texts) for s in suffixes.scan([t], 50, 16)
                 for f in s.first[s.begins]}
        assert together == alone  # stretches of a text do not depend on its neighbours
    zero = np.cumsum([0, *map(len, texts)])
    assert sorted(w for w, *_ in whole) == [
        z + i for z, t in zip(zero, texts) for i in range(len(t) - 49)]


def test_deep_shallow_sort_orders_and_groups():
    rng = np.random.default_rng(2)
    base = rng.integers(97, 100, (300, 50)).astype(np.uint8)
    deep = np.repeat(base[:5], 60, axis=0)
    deep[np.arange(300), rng.integers(16, 50, 300)] = 120
    matrix = np.concatenate([base, deep, base[:40]])
    order, begins = suffixes.sorted_repeats(matrix)
    groups = [g.tolist() for g in np.split(order, begins[1:])]
    strings = [matrix[g[0]].tobytes() for g in groups]
    assert strings == sorted({r.tobytes() for r in matrix})
    assert sorted(i for g in groups for i in g) == list(range(len(matrix)))
    assert all(matrix[i].tobytes() == s for g, s in zip(groups, strings, strict=True) for i in g)


def test_multikey_quicksort_splits_large_ranges():
    rng = np.random.default_rng(4)
    matrix = rng.integers(97, 99, (80_000, 50)).astype(np.uint8)
    matrix[:40_000, :16] = 97
    pieces = [np.split(rows, starts[1:]) for rows, starts in suffixes.multikey_sorted(matrix, 16)]
    groups = [g for piece in pieces for g in piece]
    heads = [{matrix[i, :16].tobytes() for i in g} for g in groups]
    assert all(len(h) == 1 for h in heads)
    flat = [h.pop() for h in heads]
    assert flat == sorted(set(flat)) and sorted(np.concatenate(groups)) == list(range(len(matrix)))


# --- embeddings ---------------------------------------------------------------------------


def brute_vectors(table, cosine):
    def unit(v):
        if v is None or None in v or not v or not np.isfinite(v).all() or not np.any(v):
            return None
        x = np.asarray(v, np.float64)
        return x / np.sqrt(x @ x)

    units = [(i, label, unit(v)) for i, v, label in table]
    links = [
        (a, b) for n, (a, la, x) in enumerate(units) for b, lb, y in units[n + 1 :]
        if la is not None and la == lb and x is not None and y is not None and len(x) == len(y)
        and x @ y >= cosine]
    degree = {i: 0 for i, _, _ in units}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, reachable(list(degree), links)


def vectors(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    table, ids = [], rng.permutation(n * 3)[: n + 12].tolist()
    centers = rng.normal(size=(12, dim))
    for k in range(n):
        v = centers[k % 12] + rng.normal(size=dim) * rng.choice([0.03, 0.1, 0.4]) if k % 3 else rng.normal(size=dim)
        table.append((ids[k], [float(np.float32(x)) for x in v], int(k % 12 % 2)))
    v = table[1][1]
    odd = [(v, 1), (v, 1), (v, 0), ([2 * x for x in v], 1), (None, 1), ([0.0] * dim, 1), ([float("nan")] + v[1:], 1),
           ([None] + v[1:], 1), (v, None), (v[:5], 1), ([], 1), ([float("inf")] + v[1:], 1)]
    return table + [(ids[n + i], e, label) for i, (e, label) in enumerate(odd)]


@pytest.mark.parametrize("options", [{}, {"list_rows": 16, "block_rows": 8, "sample_rows": 100}])
def test_vectors_equal_brute_force(spark, rows, options):
    table = vectors(3)
    degree, want = brute_vectors(table, 0.98)
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit(1) for c in ("head", "weight", "list", "dim", "vector")})
    got = rows(pq.near_duplicates(df, **options), "vec_id")
    assert len(got) == len(table)
    for i, row in got.items():
        assert (row["n_links"], row["component_id"], row["kept"]) == (degree[i], want[i], want[i] == i), i


def test_vectors_odd_rows(spark, rows):
    schema = "vec_id long, embedding array<float>, label int"
    assert pq.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = rows(pq.near_duplicates(spark.createDataFrame(
        [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (9, None, None)], schema)), "vec_id")
    assert got[None]["component_id"] is None and got[None]["kept"]
    assert got[4]["n_links"] == 1 and got[4]["kept"] and got[9]["n_links"] == 0


def test_vectors_beyond_the_range_of_squares(spark, rows):
    """Only zero and non-finite vectors are left out, however small or large the others are."""
    table = [(1, [1.0, 2.0]), (2, [1e-200, 2e-200]), (3, [1e200, 2e200]), (4, [5e-324, 1e-323]), (5, [1e308, -1e308]),
             (6, [1e-300, -1e-300]), (7, [0.0, -0.0]), (8, [1e200, 1.0]), (9, [3e-160, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in table], "vec_id long, embedding array<double>, label int")
    got = rows(pq.near_duplicates(df), "vec_id")
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (1, 8), 9: (1, 8)}


# --- the pipeline's stages on repeated and missing ids ------------------------------------------


def test_stages_work_by_row(spark, documents, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    copy, other, leak, clean, last = (sentence(rng, 40) for _ in range(5))
    passage = sentence(rng, 30)
    df = documents([(3, copy), (3, copy), (None, copy), (5, copy), (4, other), (7, other), (7, clean), (None, last),
                    (None, last)], extra=True)
    left = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert left.columns == df.columns and left.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert sorted((tuple(r)[:2] for r in left.collect()), key=str) == sorted(
        [(3, copy), (4, other), (7, clean), (None, last)], key=str)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = documents([(2, leak), (2, clean), (None, leak), (None, clean), (6, other)])
    left = corpus_pipeline.drop_leaks(spark, df, str(tmp_path))
    assert sorted((tuple(r)[:2] for r in left.collect()), key=str) == sorted(
        [(2, clean), (None, clean), (6, other)], key=str)
    df = documents([((1 << 63) - 1, "first " + passage), (8, "a " + passage), (None, "b " + passage), (8, "a " + passage)])
    texts = [(r.doc_id, r.text) for r in corpus_pipeline.cut_repeats(spark, df, "").collect()]
    assert len(texts) == 4 and sum(passage in t for _, t in texts) == 1
    assert sum(i is None for i, _ in texts) == 1 and sum(i == 8 for i, _ in texts) == 2
