"""Registered queries against their SQL or the operators' own law; the pipeline against its stages."""

import hashlib
from pathlib import Path

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_queries_with_sql(spark):
    from remitmatch.llm.oracles import ORACLE

    con = duck(SF_DIR)
    for name, sql in ORACLE.items():
        assert compare(entry.queries()[name](spark, SF_DIR), con, sql) is None, name


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage's rows against a plain computation over the rows of the stage before."""
    import corpus_pipeline
    from test_duplicates import brute_near, brute_repeats
    from test_text_operators import PATTERN, RANKS, library

    from remitmatch.llm import tiling, toxicity

    assert PATTERN and RANKS
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "encoding":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    scores = toxicity.toxicity_scores(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert set(kept["toxicity"]) == {r.doc_id for r in scores.collect() if not r.predicted}
    texts = [(i, before[i].text) for i in kept["toxicity"]]
    _, roots = brute_near(texts, 5, 80)
    assert set(kept["near_duplicates"]) == {i for i, root in roots.items() if i == root}
    digests = {i: sha for i, _, _, _, sha in brute_repeats(list(kept["near_duplicates"].items()))}
    exact = sum(hashlib.sha256(t.encode()).hexdigest() == digests[i] for i, t in kept["repeats"].items())
    assert set(kept["repeats"]) == set(digests) and exact >= 0.9 * len(digests)  # else a character was cut
    items = {r.item_id: [int(h) for h in tiling.word_hashes(r.text.encode())]
             for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    leaks = set()
    for i, text in kept["repeats"].items():
        words = [int(h) for h in tiling.word_hashes((text or "").encode())]
        for item in items.values():
            if sum(t[2] for t in tiling.tile(item, words, 5)) >= 0.6 * len(item):
                leaks.add(i)
    assert set(kept["decontamination"]) == set(kept["repeats"]) - leaks
    encode = library().encode_ordinary
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == set(kept["decontamination"])
    for i, row in got.items():
        text = kept["decontamination"][i] or ""
        assert row.n_tokens == len(encode(text))
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(got)
