"""License scans by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words of a document (a rolling 2-gram, hashed) is joined to the places
where the same pair stands in a license template. A match votes for the diagonal document place
minus template place: a phrase quoted whole puts all its votes on one diagonal. Neighbouring
diagonals (up to ``slack`` apart) are merged, so notices with a word added or left out still add
up, and a span counts when enough of its template is covered; the words themselves are compared
in the join, so a hash collision casts no vote.

Templates are of two kinds. A phrase (base) needs all its pairs on one diagonal. A notice needs
``coverage`` of its pairs on merged diagonals, among them those that tell it from its neighbours ("by nc",
"lesser general"): a notice without them is another license, however much of the rest stands. Templates
are a fixed list in this module; their pairs (a few hundred rows) are the only broadcast. Templates covered
alike are all reported; a text of any length is one array of words.

Nulls: a null text is empty and has no words; rows that repeat an id are scanned each by itself
and reported as one, their counts added. A null id is reported like any other. Empty tables give
no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The phrases of the contract with their labels, then notices of our own choice.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# A notice: its words, its label, and the word pairs that tell it from its neighbours.
_CC_KINDS = ("", "sa", "nd", "nc", "nc sa", "nc nd")
_CC_WORDS = {"sa": "sharealike", "nd": "noderivatives", "nc": "noncommercial"}


def _creative_commons(versions: Sequence[str] = ("4 0", "3 0")) -> list[tuple[str, str, tuple[str, ...]]]:
    """Title and short form of every kind of license: the elements and what follows them must stand."""
    found = []
    for version in versions:
        for kind in _CC_KINDS:
            for before, opening, after in (
                ("licensed under cc by", "by", kind),
                ("creative commons attribution", "attribution", " ".join(_CC_WORDS[k] for k in kind.split())),
            ):
                tail = " international license" if opening == "attribution" else ""
                line = [opening, *after.split(), version.split()[0]]
                needed = tuple(f"{x} {y}" for x, y in zip(line, line[1:], strict=False))
                text = " ".join([before, *after.split(), version]) + tail
                found.append((text, "-".join(["cc", "by", *kind.split()]), needed))
    return found


NOTICES = (
    ("released under the mit license", "mit", ("mit license",)),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ("person obtaining",)),
    ("licensed under the apache license version 2 0", "apache", ("apache license",)),
    ("this work is licensed under the gnu general public license version 3", "gpl", ("gnu general", "public license")),
    ("gnu lesser general public license", "lgpl", ("lesser general",)),
    ("gnu affero general public license", "agpl", ("affero general",)),
    ("redistribution and use in source and binary forms with or without modification", "bsd", (
        "redistribution and", "without modification")),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", ("mozilla public",)),
    *_creative_commons(),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str):
    """The words of a text column: A-Z lowered, split at ASCII other than letters and digits."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def templates(phrases: Sequence[tuple], notices: Sequence[tuple]) -> list[tuple]:
    """``template, label, base, pairs, need, place, t1, t2`` of every word pair; ``need``: bits of the needed places."""
    rows = []
    for template, (base, (text, label, *needed)) in enumerate(
        [(True, p) for p in phrases] + [(False, p) for p in notices]
    ):
        parts = text.split(" ")
        if not 2 <= len(parts) <= 64:
            raise ValueError(f"a template has 2 to 64 words: {text!r}")
        pairs = list(zip(parts, parts[1:], strict=False))
        wanted = {tuple(n.split(" ")) for n in (needed[0] if needed else ())}
        if not wanted <= set(pairs):
            raise ValueError(f"needed pairs are not all in the template: {text!r}")
        need = sum(1 << place for place, pair in enumerate(pairs) if pair in wanted)
        rows += [(template, label, base, len(pairs), need, place, *pair) for place, pair in enumerate(pairs)]
    return rows


def template_pairs(spark: SparkSession, phrases: Sequence[tuple], notices: Sequence[tuple]) -> DataFrame:
    """One row per place of a word pair in a template."""
    return spark.createDataFrame(
        templates(phrases, notices),
        "template int, label string, base boolean, pairs int, need long, place int, t1 string, t2 string"
    ).withColumn("hash", F.xxhash64("t1", "t2"))


def license_spans(
    docs: DataFrame,
    phrases: Sequence[tuple] = PHRASES,
    notices: Sequence[tuple] = NOTICES,
    coverage: float = 0.6,
    slack: int = 2,
) -> DataFrame:
    """Verified spans: ``doc_id, row, label, base, first_word, covered, copies``.

    ``covered`` is the share of the template's pairs, ``row`` a hash of the text, which tells apart
    rows that share an id; ``copies`` counts equal rows.
    """
    return _spans(_tokens(docs), docs.sparkSession, phrases, notices, coverage, slack)


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.xxhash64("text").alias("row"), words("text").alias("words"))


def _spans(tokens, spark, phrases, notices, coverage, slack) -> DataFrame:
    pairs = template_pairs(spark, phrases, notices)
    rolling = tokens.where(F.size("words") > 1).select(
        "doc_id", "row",
        F.posexplode(F.arrays_zip(
            F.col("words").alias("w1"), F.slice("words", F.lit(2), F.size("words")).alias("w2")
        )).alias("at", "pair"),
    ).select("doc_id", "row", "at", F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2"))
    votes = (
        rolling.where("w2 IS NOT NULL").withColumn("hash", F.xxhash64("w1", "w2"))
        .join(F.broadcast(pairs), "hash").where("w1 = t1 AND w2 = t2")
        .withColumn("diagonal", F.col("at") - F.col("place"))
    )
    diagonals = votes.groupBy("doc_id", "row", "template", "label", "base", "pairs", "need", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("at").alias("low"),
        F.expr("bit_or(shiftleft(1L, place)) AS seen"))
    whole = diagonals.where("base AND bit_count(seen) = pairs").select(
        "doc_id", "row", "label", "base", F.col("diagonal").cast("long").alias("first_word"),
        F.lit(1.0).alias("covered"), F.expr("votes div pairs AS copies"))

    line = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line) > slack
    runs = diagonals.where("NOT base").withColumn(
        "run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(line))
    merged = runs.groupBy("doc_id", "row", "template", "label", "base", "pairs", "need", "run").agg(
        F.expr("bit_or(seen) AS seen"), F.min("low").alias("first_word"))
    notice = merged.withColumn("covered", F.expr("bit_count(seen) / pairs")).where(
        F.col("covered") >= coverage).where("seen & need = need").select(
        "doc_id", "row", "label", "base", F.col("first_word").cast("long").alias("first_word"),
        "covered", F.lit(1).cast("long").alias("copies"))
    return whole.unionByName(notice)


def license_scan(
    docs: DataFrame,
    phrases: Sequence[tuple] = PHRASES,
    notices: Sequence[tuple] = NOTICES,
    coverage: float = 0.6,
    slack: int = 2,
) -> DataFrame:
    """One row per document id: word count, base places and labels, all labels, best coverage."""
    tokens = _tokens(docs)
    spans = _spans(tokens, docs.sparkSession, phrases, notices, coverage, slack)
    none = {"label": "string", "base": "boolean", "first_word": "long", "covered": "double", "copies": "long"}
    rows = tokens.select(
        "doc_id", F.size("words").cast("long").alias("n"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()])
    found = spans.select("doc_id", F.lit(0).cast("long").alias("n"), *none)
    sorted_labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return rows.unionByName(found).groupBy("doc_id").agg(
        F.sum("n").alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("base"), F.col("copies"))), F.lit(0)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
        sorted_labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        sorted_labels("label").alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
    )
