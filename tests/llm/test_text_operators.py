"""License scans, shards, classifiers, tiling, BPE and token files."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from remitmatch.llm import bpe, cotraining, hilbert, licenses, tiling, tokenfiles, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN

ODD_TEXTS = [
    "Released under the MIT License.", "x MIT  license, mit\nLICENSE mit license", None, "", " \n\t  ",
    "It's 2024: naïve café — 東京タワー 🙂🙂 don't stop now\x1cand\x85then ", "a" * 3000, "  lead", "tail  \n\n",
    "<|endoftext|> 'LL 'll we'll 1234567890123 ½ Ⅻ ́e﻿", "word " * 400, "\x00\x01\x7f", "ß" * 70,
]

# --- licenses -----------------------------------------------------------------------------


def brute_licenses(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split(" ")
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def test_license_base_equals_brute_force(documents, rows):
    texts = list(enumerate(ODD_TEXTS + [
        "apache license apache license", "GENERAL-PUBLIC-LICENSE", "general public mit license",
        "general public license", "the general public license of the mit license"]))
    got = rows(licenses.license_scan(documents(texts, extra=True)))
    for i, text in texts:
        row = got[i]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute_licenses(text)
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1


def test_license_notices_with_words_changed(documents, rows):
    got = rows(licenses.license_scan(documents([
        "licensed under cc by nc 4 0", "Licensed, under a CC BY-NC 4.0", "licensed under the cc of nothing",
        "redistribution and use in source or binary forms with or without modification"])))
    assert got[0]["labels"] == "cc-by-nc" and got[0]["score"] == 1.0
    assert got[1]["labels"] == "cc-by-nc" and 0.6 <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[2]["score"] == 0.0
    assert got[3]["labels"] == "bsd"


LICENSE_TEXTS = {
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY SA 4.0.": "cc-by-sa",
    "licensed under CC-BY-ND 4.0": "cc-by-nd",
    "Licensed under CC BY-NC 4.0": "cc-by-nc",
    "Licensed under a CC BY-NC-SA 3.0": "cc-by-nc-sa",
    "Licensed under CC BY-NC-ND 4.0": "cc-by-nc-nd",
    "Creative Commons Attribution 4.0 International License": "cc-by",
    "This is a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa",
    "Creative Commons Attribution-NoDerivatives 4.0 International License": "cc-by-nd",
    "Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "cc-by-nc-sa",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": "cc-by-nc-nd",
    "This work is licensed under the GNU General Public License, version 3": "gpl",
    "GNU Lesser General Public License": "gpl,lgpl",  # the base phrase stands in it, so its label stays
    "GNU Affero General Public License": "agpl,gpl",
    "Licensed under the Apache License, Version 2.0": "apache",
    "licensed under the Mozilla license, version 2.0": "",
    "this work is licensed under the MIT license, version 3": "mit",
    "this work is licensed under the own public license version 3": "",
    "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy": "",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "this source code form is subject to the terms of the other public license": "",
}


def test_every_license_gets_its_own_label(documents, rows):
    got = rows(licenses.license_scan(documents(list(LICENSE_TEXTS))))
    assert {t: got[i]["labels"] for i, t in enumerate(LICENSE_TEXTS)} == LICENSE_TEXTS


def test_license_odd_rows(documents, rows):
    got = rows(licenses.license_scan(documents([(1, "mit license"), (1, "mit license"), (1, "apache license x"), (None, "mit license")])))
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["base_labels"]) == (7, 3, "apache,mit")
    assert got[None]["n_base"] == 1
    assert licenses.license_scan(documents([])).count() == 0


# --- shards -------------------------------------------------------------------------------


@pytest.mark.parametrize(("bits", "dims"), [(3, 2), (2, 3), (5, 2), (4, 1)])
def test_hilbert_curve_visits_neighbours(bits, dims):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def shard_rows(documents):
    rng = random.Random(5)
    texts = [(i, "w " * rng.randrange(0, 300)) for i in range(333)] + [(7, "same")] * 200 + [(None, None), (8, "ü")]
    return documents(texts, extra=True).withColumns({
        "lang": F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat('l', doc_id % 4) END"),
        "source": F.expr("concat('src', doc_id % 17)")})


def test_shards_hold_the_law(documents):
    got = hilbert.hilbert_shards(shard_rows(documents)).collect()
    assert len(got) == 535
    counts = [sum(r.shard == s for r in got) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    line = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in line] == sorted(r.curve for r in got)
    assert len({r.curve for r in got}) > 50
    for r in got:
        if r.doc_id == 8 and r["size"] == 3:
            assert r.text_crc32 == zlib.crc32("ü".encode())
        if r.doc_id is None:
            assert (r["size"], r.text_crc32) == (1, 0)
        assert r.law == "rows" and r.grown_shard is None


def test_strings_that_begin_alike_get_cells_of_their_own(documents):
    df = documents(["w"] * 400).withColumn("source", F.expr(
        "CASE WHEN doc_id = 399 THEN NULL WHEN doc_id % 2 = 0 THEN 'https://é/z'"
        " ELSE concat('https://host/', lpad(doc_id % 20, 2, '0')) END"))
    got = hilbert.with_curve(df, ["source"], 3).select("source", "_d0").distinct().collect()
    values = sorted((r.source for r in df.collect() if r.source is not None), key=str.encode)
    edges = sorted({values[-(-len(values) * k // 8) - 1] for k in range(1, 8)}, key=str.encode)
    assert len(got) == 12  # ten hosts, the common one, null
    for r in got:
        assert r._d0 == (0 if r.source is None else sum(e.encode() < r.source.encode() for e in edges))
    assert len({r._d0 for r in got}) == 4
    assert hilbert.with_curve(documents(["a"]).withColumn("lang", F.lit(None).cast("string")), ["lang"]).first()._d0 == 0


def test_shards_of_few_or_no_rows(documents):
    assert hilbert.hilbert_shards(documents([])).count() == 0
    got = hilbert.hilbert_shards(documents(["a", "b", "c"])).collect()
    assert len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}


def test_written_shards_prune(spark, documents, tmp_path):
    df = shard_rows(documents)
    hilbert.write_shards(df, str(tmp_path / "shards"), shards=8)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == df.count()
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    boxes = back.groupBy("shard").agg(F.count_distinct("source").alias("n")).collect()
    assert np.mean([r.n for r in boxes]) < 17


# --- classifiers --------------------------------------------------------------------------


def labelled(spark, documents, column, n=600):
    rng = random.Random(8)
    texts, marks = [], []
    for i in range(n):
        words = ["w" + str(rng.randrange(400)) for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.3
        if bad and column == "toxic":
            for _ in range(2):
                words.insert(rng.randrange(len(words)), "vile" + rng.choice("abcdefgh") + str(rng.randrange(9)))
        if not bad and column == "quality":
            words = [w + ("." if k % 6 == 5 else "") for k, w in enumerate(words)]
        if bad and column == "quality":
            words = [w + rng.choice(["$$$", "###"]) for w in words]
        texts.append((i, " ".join(words)))
        marks.append((i, int(bad) if column == "toxic" else int(not bad)))
    labels = spark.createDataFrame([m for m in marks if m[0] % 2 or m[0] < 300] + [(None, 1), (99999, 0), (5, None)], f"doc_id long, {column} int")
    return documents(texts, extra=True), labels, dict(marks)


def area(pairs):
    good = [s for s, m in pairs if m]
    bad = [s for s, m in pairs if not m]
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


def test_toxicity_on_held_out_rows(spark, documents):
    docs, labels, marks = labelled(spark, documents, "toxic")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(marks)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert area([(r.score, marks[r.doc_id]) for r in got if r.held_out]) > 0.95
    hits = sum(r.predicted == marks[r.doc_id] for r in got if r.held_out) / sum(r.held_out for r in got)
    assert hits > 0.9


def test_toxicity_learns_from_every_labelled_row(spark, documents, monkeypatch):
    """Rows beyond one shard and long texts count too: all but every fifth are trained on."""
    docs, labels, marks = labelled(spark, documents, "toxic")
    docs = docs.withColumn("text", F.expr("CASE WHEN doc_id = 1 THEN concat(text, repeat(' w1', 80000)) ELSE text END"))
    asked = labels.where("toxic IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 4 != 2").join(docs, "doc_id").count()
    sizes, cuts = [], []
    monkeypatch.setattr(toxicity, "cut", lambda df, name, cut=toxicity.cut: cuts.append(cut(df, name)) or cuts[-1])
    monkeypatch.setattr(toxicity, "discard", lambda *frames, gone=toxicity.discard: (
        sizes.extend([frames[0].agg(F.sum("n")).first()[0], frames[1].agg(F.sum("n")).first()[0]]), gone(*frames)))
    got = toxicity.toxicity_scores(docs, labels, shard_rows=90, epochs=25).collect()
    assert sizes[0] == asked and asked / 6 < sizes[1] < asked / 3.5
    assert area([(r.score, marks[r.doc_id]) for r in got if r.held_out]) > 0.95


def test_toxicity_shuffles_no_text_without_label(spark, documents, monkeypatch):
    """Only labelled texts reach the shards, in one shuffle, however large the labels are."""
    docs, labels, marks = labelled(spark, documents, "toxic")
    few = labels.where("doc_id % 3 = 0")
    asked = few.where("toxic IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 4 != 2").join(docs, "doc_id").count()
    plans, seen = [], []
    monkeypatch.setattr(toxicity, "cut", lambda df, name, cut=toxicity.cut: plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())) or cut(df, name))
    real = toxicity._perhaps_in
    monkeypatch.setattr(toxicity, "_perhaps_in", lambda *a: seen.append(real(*a).count()) or real(*a))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = toxicity.toxicity_scores(docs, few, shard_rows=60, epochs=2).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(got) == len(marks)
    assert "SortMergeJoin" not in dict(plans)["toxicity_shards"]
    assert asked <= seen[0] <= asked + 3


def test_toxicity_packs_a_shard_once_per_id():
    """Rows that repeat an id or have no label are left out; the others stand in the order of their places."""
    n = 400
    ids, known = [i // 2 for i in range(n)], range(0, n, 3)
    texts = [f"word{i} " * 20 if i % 7 else None for i in range(n)]
    lang = ["de" if i % 3 else None for i in range(n)]
    rows = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": lang,
                     "place": pa.array([i * 7919 % 1009 for i in ids], pa.int64())})
    marked = pa.table({"doc_id": pa.array(known, pa.int64()), "toxic": pa.array([i % 2 for i in known], pa.int32())})
    (numbers, buckets, marks, spoken), = toxicity._shards(toxicity._packed(rows, marked).to_batches())
    want = [(i, *min(((texts[k], lang[k]) for k in (2 * i, 2 * i + 1)), key=lambda r: (r[0] is None, r[0] or "")))
            for i in sorted(set(ids) & set(known), key=lambda i: i * 7919 % 1009)]
    assert marks.tolist() == [i % 2 for i, _, _ in want]
    assert spoken == [x for _, _, x in want]
    assert [len(x) for x in numbers] == [len((text or "").split()) + 2 + (not text) for _, text, _ in want]
    assert len(buckets) == 1 + len({w for _, text, _ in want for w in (text or "").split()})


def test_toxicity_packs_a_shard_without_copies_of_its_texts(monkeypatch):
    """Arrow holds the texts once when they are numbered, and a shard is read without a copy of its numbers."""
    held = []
    monkeypatch.setattr(toxicity, "Vocabulary", lambda real=toxicity.Vocabulary: held.append(pa.total_allocated_bytes()) or real())
    ids = pa.array(range(400), pa.int64())
    rows = pa.table({"doc_id": ids, "text": [f"word{i} " * 2000 for i in range(400)], "lang": ["de"] * 400, "place": ids})
    marked = pa.table({"doc_id": ids, "toxic": pa.array([i % 2 for i in range(400)], pa.int32())})
    before = pa.total_allocated_bytes()
    packed = toxicity._packed(rows, marked)
    assert held[0] - before < rows.column("text").nbytes / 10
    (texts, *_), = toxicity._shards(packed.to_batches())
    assert not any(x.flags.owndata for x in texts)


def test_toxicity_map_of_ids_loses_none(spark, documents):
    docs = documents([(i * 7919 - 5, "a") for i in range(300)] + [(None, "b")])
    marked = docs.where("doc_id % 2 = 0").select("doc_id")
    wanted = {r.doc_id for r in marked.collect()}
    for bits in (1 << 25, 64):
        kept = toxicity._perhaps_in(marked, docs, bits)
        assert kept.columns == docs.columns
        assert wanted <= {r.doc_id for r in kept.collect()}
    assert {r.doc_id for r in toxicity._perhaps_in(marked, docs).collect()} == wanted


def test_toxicity_pieces_of_many_words():
    words = ["a", "ab", "abc", "abcdefghij", "\u00e9", "ab\u00e9", "abcdefg\u00e9h", "\u65e5\u672c\u8a9e" * 4, "\U0001d4b3" * 9, ""]
    assert toxicity.all_pieces(words).tolist() == [toxicity.pieces(w) for w in words]


def test_toxicity_ignores_labels_of_held_out_rows(spark, documents):
    docs, labels, _ = labelled(spark, documents, "toxic", 200)
    flipped = labels.withColumn("toxic", F.expr(
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END"))
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity_scores(docs, x, epochs=2).collect()} for x in (labels, flipped))
    assert one == two


def test_toxicity_scores_do_not_see_lang_or_source(spark, documents):
    docs, labels, _ = labelled(spark, documents, "toxic", 200)
    other = docs.withColumns({"source": F.lit("other")})
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity_scores(x, labels, epochs=2).collect()} for x in (docs, other))
    assert one == two


def test_toxicity_odd_rows(spark, documents):
    docs, labels, _ = labelled(spark, documents, "toxic", 200)
    odd = documents([(None, "w1 vilea1"), (1, None), (1, ""), (2, "w " * 100_000 + "vilea1 vileb2"), (2, "w " * 100_000)], extra=True)
    got = toxicity.toxicity_scores(docs.where("doc_id > 2").union(odd), labels).collect()
    assert len([r for r in got if r.doc_id == 1]) == 2 and len({r.score for r in got if r.doc_id == 1}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    long = [r.score for r in got if r.doc_id == 2]
    assert long[0] > long[1]
    empty = labels.limit(0)
    assert {r.score for r in toxicity.toxicity_scores(odd, empty).collect()} == {0.0}
    assert toxicity.toxicity_scores(documents([]), labels).count() == 0
    assert toxicity.reject_toxic(documents([]), labels).count() == 0


def test_reject_toxic_keeps_rows_and_columns(spark, documents):
    docs, labels, marks = labelled(spark, documents, "toxic")
    left = toxicity.reject_toxic(docs, labels)
    assert left.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert {r.doc_id for r in left.collect()} == {i for i, p in scores.items() if not p}


def test_quality_by_cotraining(spark, documents):
    docs, labels, marks = labelled(spark, documents, "quality")
    known = {r.doc_id for r in labels.collect()}
    got = cotraining.quality_scores(docs, labels, fit_rows=300, pool_rows=200).collect()
    assert len(got) == len(marks)
    assert area([(r.score, marks[r.doc_id]) for r in got if r.doc_id not in known]) > 0.95
    assert all(r.kept == (r.score >= 0.5) for r in got)


def test_cotraining_hands_labels_from_view_to_view():
    """A view with few labelled rows learns from what the other view is sure of."""
    rng = np.random.default_rng(1)
    marks = (rng.random(900) < 0.5).astype(float)
    text = marks[:, None] * 3 + rng.normal(size=(900, 4))
    page = marks[:, None] * 0.4 + rng.normal(size=(900, 40))
    alone = cotraining.cotrain(text[:16], page[:16], marks[:16], text[:0], page[:0], 4, 0.2)
    both = cotraining.cotrain(text[:16], page[:16], marks[:16], text[16:500], page[16:500], 4, 0.2)
    rest = slice(500, None)
    accuracy = [np.mean((m.page.logits(page[rest]) > 0) == marks[rest]) for m in (alone, both)]
    assert accuracy[1] > accuracy[0]


def test_the_surest_of_all_documents_are_handed_over(spark, documents):
    """One round of the Spark choice against plain loops over every row, with copies and rows already taken."""
    docs, labels, _ = labelled(spark, documents, "quality")
    docs = docs.union(docs.where("doc_id % 3 = 0")).union(docs.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)).limit(40))
    rows = cotraining.featured(docs.repartition(5), labels)
    assert rows.count() == docs.count()
    pool = rows.where("mark IS NULL").select("key", "features")
    stored = {r.key: bytes(r.features) for r in pool.collect()}
    views = {k: cotraining.unpacked(np.frombuffer(v, cotraining.ROW)) for k, v in stored.items()}
    rng = np.random.default_rng(2)
    models = {}
    for view in cotraining.VIEWS:
        x = np.concatenate([v[view] for v in views.values()])
        models[view] = cotraining.Logistic(x, (rng.random(len(x)) < 0.5).astype(float), np.ones(len(x)), 20)
    done = sorted(stored)[::4]
    taken = {"text": np.array(done, np.int64), "page": np.zeros(0, np.int64)}
    got = cotraining._handed(pool, models, taken, (11, 7))
    for view, other in (("text", "page"), ("page", "text")):
        want = []
        for kind, size in ((0, 11), (1, 7)):
            ranked = []
            for key, value in views.items():
                logit = float(models[view].logits(value[view])[0])
                if (logit > 0) == bool(kind) and not (other == "text" and key in done):
                    ranked.append((round(-abs(logit), 9), key))
            want += [(kind, key) for _, key in sorted(ranked)[:size]]
        by_features = {v: k for k, v in stored.items()}
        have = [(int(g), by_features[r.tobytes()]) for r, g in zip(*got[other])]
        if view == "text":  # few values of the page view: ties to the last bit may fall either way
            assert have == want
        assert [g for g, _ in have] == [g for g, _ in want] and len(set(have)) == len(have)
        assert {k for _, k in have} <= set(taken[other].tolist())


def test_quality_odd_rows(spark, documents):
    docs, labels, _ = labelled(spark, documents, "quality", 200)
    odd = documents([(None, "w1"), (1, None), (1, ""), (2, "w " * 50_000)], extra=True).withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    assert cotraining.quality_scores(docs.where("doc_id > 2").union(odd), labels).count() == 201
    assert {r.score for r in cotraining.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert cotraining.quality_scores(documents([]), labels).count() == 0


# --- tiling -------------------------------------------------------------------------------


def slow_tiles(item, text, shortest):
    """Greedy tiling by looking at every pair of places."""
    taken, used, covered = [False] * len(item), [False] * len(text), 0
    for size in range(len(item), shortest - 1, -1):
        for a in range(len(item) - size + 1):
            for b in range(len(text) - size + 1):
                if (item[a : a + size] == text[b : b + size] and not any(taken[a : a + size])
                        and not any(used[b : b + size])):
                    taken[a : a + size] = used[b : b + size] = [True] * size
                    covered += size
    return covered


def test_tiles_equal_slow_search():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 25))]
        text = [rng.randrange(1, 6) for _ in range(rng.randrange(0, 40))]
        for _ in range(2):
            a = rng.randrange(len(item))
            b = rng.randrange(len(text) + 1)
            text[b:b] = item[a : a + rng.randrange(12)]
        tiles = tiling.tile(item, text, 3)
        assert sum(t[2] for t in tiles) == slow_tiles(item, text, 3)
        assert all(item[a : a + n] == text[b : b + n] for a, b, n in tiles)


def leak_tables(spark, documents):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (15, 24, 40, 59, 4)]
    filler = lambda n: [word() for _ in range(n)]
    texts = [filler(80) for _ in range(30)]
    texts[3] += items[0]
    texts[4] = filler(50) + items[1][12:] + filler(9) + items[1][:12] + filler(7)  # in another order
    texts[5] = filler(9) + items[2][:6] + filler(9)  # a short quotation only
    texts[6] = items[3][:20] + ["odd"] + items[3][21:] + filler(3)
    texts[7] = items[4] + filler(3)
    lines = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100, " ".join(items[0]).upper() + "!"), (None, " ".join(items[0])), (101, None), (102, "")]
    lines += [(3, " ".join(texts[3]))]
    bench = spark.createDataFrame(
        [(i, " ".join(t), 1) for i, t in enumerate(items)] + [(9, None, 1), (10, "", 1), (None, "a b c d e f", 1), (0, " ".join(items[0]), 1)],
        "item_id long, text string, doc_id int")
    return documents(lines, extra=True), bench


@pytest.mark.parametrize("limit", [10_000, 0])
def test_contaminated_pairs(spark, documents, limit):
    docs, bench = leak_tables(spark, documents)
    got = tiling.contaminated_pairs(docs, bench, broadcast_seeds=limit).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(3, 0), (4, 1), (6, 3), (100, 0)}
    assert len(got) == 4
    tiles = {r.doc_id: (r.n_words, r.n_covered, r.n_tiles) for r in got}
    assert tiles[3] == (15, 15, 1) and tiles[4] == (24, 24, 2) and tiles[6] == (59, 58, 2)


def test_decontaminate(spark, documents):
    docs, bench = leak_tables(spark, documents)
    left = tiling.decontaminate(docs, bench)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert ids == ({*range(30)} | {101, 102, None}) - {3, 4, 6}
    assert tiling.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert tiling.contaminated_pairs(documents([]), bench).count() == 0


@pytest.mark.parametrize("limit", [10_000, 0])
def test_long_passages_of_longer_items(spark, documents, limit):
    words = [f"w{i}" for i in range(1000)]
    other = [f"x{i}" for i in range(40)]
    pieces = [w for k in range(0, 500, 25) for w in [*words[k : k + 24], "odd"]]  # many tiles, none long
    texts = [other + words[100:650] + other, other + words[:50], other + words[:49], pieces, other]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = documents([" ".join(t) for t in texts])
    got = {r.doc_id: (r.n_covered, r.coverage) for r in tiling.contaminated_pairs(docs, bench, broadcast_seeds=limit).collect()}
    assert got == {0: (550, 0.55), 1: (50, 0.05)}
    assert {r.doc_id for r in tiling.decontaminate(docs, bench).collect()} == {2, 3, 4}


# --- BPE and token files ------------------------------------------------------------------


def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_bpe_equals_the_library(documents, block):
    texts = list(enumerate(ODD_TEXTS)) + [(3, ODD_TEXTS[3]), (None, "no id"), (0, ODD_TEXTS[0])]
    got = bpe.round_trip(documents(texts, extra=True), RANKS, PATTERN, block).collect()
    encode = library().encode_ordinary
    want = []
    for i, text in texts:
        ids = np.array(encode(text or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_bpe_of_no_rows(documents):
    assert bpe.round_trip(documents([]), RANKS, PATTERN).count() == 0
    assert sorted(tuple(r)[:2] for r in bpe.round_trip(documents(["", None]), RANKS, PATTERN).collect()) == [(0, 0), (1, 0)]


def test_packed_numbers():
    for numbers in (np.array([], np.int64), np.array([0, 239, 240, 255, 256, 70_000, (1 << 20) + 239]),
                    np.array([0, 239, 240, 70_000, (1 << 20) + 240, 1 << 30])):
        assert (bpe.unpack(bpe.pack(numbers), len(numbers)) == numbers).all()


def test_token_files_equal_the_library(documents):
    texts = [(5 * i % 13, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "again"), (None, "no id")]
    got = [tuple(r) for r in tokenfiles.round_trip(documents(texts, extra=True), VOCABULARY, PATTERN).collect()]
    encode = tokenfiles.tokenizer(VOCABULARY).encode
    start, want = 0, []
    for i, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "")):
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_added_tokens_are_found_as_by_the_library(documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    texts = ["a <|endoftext|> b", "plain words", "<|endoftext|>", "x<|endoftext|>\n\ny  <|endoftext|>  z", "<|endoftext|",
             "a\n<|endoftext|><|endoftext|>é", "a <|endoftext|> b", " |> b <|endof text|>", "last  words <|"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [50256 in w for w in want].count(True) == 5
    encoder = tokenfiles.Encoder(VOCABULARY, PATTERN)
    for size in (1, 4, len(texts)):
        for at in range(0, len(texts), size):
            found, stops = encoder.encode(texts[at : at + size])
            assert [o.tolist() for o in np.split(found, stops[:-1])] == want[at : at + size]
    got = sorted(tuple(r) for r in tokenfiles.round_trip(documents(texts), VOCABULARY, PATTERN).collect())
    start = 0
    for row, (i, ids) in zip(got, enumerate(want), strict=True):
        ids = np.array([*ids, 0], "<u4")
        assert row == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_no_rows(documents):
    assert tokenfiles.round_trip(documents([]), VOCABULARY, PATTERN).count() == 0
    assert [tuple(r)[:3] for r in tokenfiles.round_trip(documents([(4, "")]), VOCABULARY, PATTERN).collect()] == [(4, 0, 1)]


def test_encoder_equals_the_library_on_any_white_space():
    rng = random.Random(6)
    encoder = tokenfiles.Encoder(VOCABULARY, PATTERN)
    texts = ["".join(rng.choice("aab  \n\n\t'sé1.\x85\u3000") for _ in range(rng.randrange(12))) for _ in range(4000)]
    found, stops = encoder.encode(texts)
    own = np.split(found, stops[:-1])
    library_ids = [e.ids for e in tokenfiles.tokenizer(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert [(t, o.tolist()) for t, o in zip(texts, own, strict=True)] == list(zip(texts, library_ids, strict=True))


def test_encoder_forgets_and_learns_again():
    encoder = tokenfiles.Encoder(VOCABULARY, PATTERN, remembered=3)
    texts = ["one two three four", "one five", "", "four one"]
    want = [tokenfiles.tokenizer(VOCABULARY).encode(t, add_special_tokens=False).ids for t in texts]
    for text, ids in zip(texts, want, strict=True):
        found, stops = encoder.encode([text])
        assert found.tolist() == ids and stops.tolist() == [len(ids)]
    found, stops = encoder.encode(texts)
    assert found.tolist() == sum(want, []) and stops.tolist() == np.cumsum([len(w) for w in want]).tolist()
