"""Tokenizer alignment, ranked search and word BPE against plain loops and the libraries."""

import bisect
import hashlib
import itertools
import json
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from test_text_operators import ODD_TEXTS
from tokenizers import Tokenizer

from remitmatch.llm import alignment, pairindex, reversed_search

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

MORE_TEXTS = [
    "a▁b plain words", "two  spaces\n\nand lines\n", " \n lead", "\r\n dos\r\nlines \r", "<s> </s> <unk> <0x41>",
    "tab\tin　between᠎ x", "ab" * 900 + " end", "İstanbul ΑΣ ΣΑΣ it'S ﬁ", "́ a ́b é", "<|startoftext|>A<|ENDOFTEXT|>",
    "x\t<|endoftext|>y\x1cz\x85w", "trail \t ", "� ​", "   ", "\n", "don't Don't DON'T don't",
]


def odd_texts(seed, count=150):
    rng = random.Random(seed)
    alphabet = "abABstST19.,'!<|>éßΣς́̇İ \n\t\r\x1c\x85 ​東🙂ǆ▁"
    made = ["".join(rng.choices(alphabet, [6] * 10 + [1] * (len(alphabet) - 10), k=rng.randrange(1, 60)))
            for _ in range(count)]
    spaced = ["".join(rng.choice(["ab", "the", "tion", " ", " ", "\n", "x1"]) for _ in range(30)) for _ in range(count)]
    return ODD_TEXTS + MORE_TEXTS + made + spaced


# --- alignment ----------------------------------------------------------------------------


def byte_letters():
    """The byte-level alphabet as the library itself applies it."""
    from tokenizers import pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    table = {}
    for point in [*range(0x80), *range(0x80, 0x800, 0x40), *range(0x80, 0xC0), *range(0x800, 0x10000, 0x1000),
                  *range(0x10000, 0x110000, 0x40000), 0xFFFF, 0x10FFFF]:
        if not 0xD800 <= point < 0xE000:
            raw = chr(point).encode()
            mapped = "".join(w for w, _ in level.pre_tokenize_str(chr(point)))
            table |= dict(zip(mapped, raw, strict=True))
    return table


def brute_alignment(texts):
    """The contract over (doc_id, text) rows, with dictionaries."""
    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = byte_letters()

    def piece_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) and pieces.is_byte(i) else piece.replace(
            "▁", " ").encode()

    def groups_of(text):
        if not text:
            return []
        a = own.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(letters.get(c, 0) for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
        b = [(i, piece_bytes(i)) for i in pieces.encode(text)]
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
            return []
        ends = [list(itertools.accumulate(len(t) for _, t in side)) for side in (a, b)]
        borders = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in borders]
        for which, (side, end) in enumerate(zip((a, b), ends, strict=True)):
            for (i, _), e in zip(side, end, strict=True):
                groups[bisect.bisect_left(borders, e)][which].append(i)
        return groups

    found = [groups_of(t) for _, t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    count = Counter(pair for own_links in links for pair in own_links)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    rows = []
    for (doc_id, _), groups, own_links in zip(texts, found, links, strict=True):
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
            sum(own_links.values()), sum(n for p, n in own_links.items() if count[p] == highest[p[0]]),
            sum(n * count[p] for p, n in own_links.items()),
            hashlib.sha256(spelt.encode()).hexdigest() if groups else ""))
    return rows


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


@pytest.mark.parametrize(("block", "fan_in"), [(1 << 23, 256), (3000, 4)])
def test_alignment_equals_brute_force(documents, block, fan_in):
    texts = list(enumerate(odd_texts(1)))
    texts += [(3, "the same text again"), (3, "the same text again"), (None, "the tion again"), (None, None)]
    df = documents(texts, extra=True).repartition(3)
    got = alignment.align_documents(df, BYTES, PIECES, block, fan_in)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_alignment(texts), key=key)


def test_alignment_of_long_texts(documents, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 500)
    own = alignment.Aligner(BYTES, PIECES)
    text = " " + "word 東京, lines\nand more  x " * 200
    parts = own.number(text)
    names = list(own.numbers)
    assert "".join(names[k] for k in parts.tolist()) == text
    texts = [(1, "ab" * 8_000), (2, "word " * 20_000)]
    got = alignment.align_documents(documents(texts), BYTES, PIECES).collect()
    assert sorted(map(tuple, got)) == brute_alignment(texts)


def test_alignment_of_a_common_text(documents):
    """Copies in every block: counts are of documents, and a pair has one row per run however common it is."""
    texts = [(i, "the common passage of all") for i in range(900)] + [(1000 + i, f"own word{i}") for i in range(40)]
    got = alignment.align_documents(documents(texts).repartition(8), BYTES, PIECES, block=500, fan_in=16)
    assert sorted(map(tuple, got.collect())) == brute_alignment(texts)


def test_alignment_of_no_rows(documents):
    assert alignment.align_documents(documents([]), BYTES, PIECES).count() == 0
    got = alignment.align_documents(documents([None, "", "▁"]), BYTES, PIECES).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "")}


# --- ranked search ------------------------------------------------------------------------

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def brute_search(docs, items, top=20):
    def words(text):
        return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    split = [(i, words(t)) for i, t in docs]
    total = sum(bool(w) for _, w in split)
    length = sum(len(w) for _, w in split)
    counts = [(i, len(w), Counter(w)) for i, w in split]
    held = Counter(t for _, _, c in counts for t in c)
    rows = []
    for item_id, text in items:
        found = []
        for doc_id, n, c in counts:
            score = 0
            for t in words(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * held[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * total // length)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        rows += [(item_id, k, None if empty else doc_id, -score)
                 for k, (score, empty, doc_id) in enumerate(sorted(found)[:top], 1)]
    return rows


@pytest.mark.parametrize("postings", [1 << 19, 40])
def test_search_equals_brute_force(spark, documents, postings):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "東京", "x-y", "A_b", "the"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 80)))) for i in range(300)]
    docs += [(i, "the copy of w1") for i in range(400, 460)] + [(5, "the copy of w1"), (None, "the copy of w1")]
    docs += [(900 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(999, "w2 " * 50_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 12)))) for i in range(20)]
    items += [(3, "W1 w1 W1 the"), (None, "the ünï A"), (30, None), (31, ""), (32, "nowhere"), (33, "the"), (33, "the")]
    asked = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, rank int, doc_id long")
    got = reversed_search.ranked_search(documents(docs, extra=True).repartition(5), asked, postings=postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_search(docs, items), key=key)


def test_search_of_a_group_of_copies(spark, documents):
    docs = [(i, "same words here") for i in range(3000)] + [(5000 + i, f"other{i} words") for i in range(50)]
    items = [(1, "same words"), (2, "other7")]
    got = reversed_search.ranked_search(
        documents(docs).repartition(6), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute_search(docs, items))


def test_search_of_no_rows(spark, documents):
    empty = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert reversed_search.ranked_search(documents([]), one).count() == 0
    assert reversed_search.ranked_search(documents(["a"]), empty).count() == 0
    assert reversed_search.ranked_search(documents([None, ""]), one).count() == 0


# --- word BPE -----------------------------------------------------------------------------


def test_word_bpe_equals_the_library(documents, rows):
    library = Tokenizer.from_file(WORDS)
    texts = list(enumerate(odd_texts(2, 400)))
    got = rows(pairindex.round_trip(documents(texts + [(None, "a b"), (None, None)], extra=True), WORDS))
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == {
            "doc_id": i, "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}, text
    assert sorted(r["n_tokens"] for r in got[None]) == [0, 2]
    assert pairindex.round_trip(documents([]), WORDS).count() == 0


def test_word_bpe_of_long_texts_and_forgetting(documents, rows, monkeypatch):
    monkeypatch.setattr(pairindex, "SYMBOLS", 64)
    library = Tokenizer.from_file(WORDS)
    words = pairindex.Words(WORDS, remembered=50)
    texts = ["long words and " * 900, "x" * 20_000, "aaaa abab banana bandana"]
    for text in texts + odd_texts(4, 50):
        parts = list(pairindex.slices(text or "", 100))
        assert "".join(parts) == (text or "")
        ids = np.frombuffer(b"".join(words.encode([p])[0] for p in parts), "<u4").tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_any_list_of_merges(tmp_path, seed):
    """Merges in any order, products that several pairs give and that come back at lower ranks."""
    rng = random.Random(seed)
    letters = "abc"
    tokens, merges = [*letters, *(c + "</w>" for c in letters)], []
    while len(merges) < 40:
        left, right = rng.choice([t for t in tokens if "<" not in t]), rng.choice(tokens)
        if [left, right] not in merges:
            merges.append([left, right])
            if left + right not in tokens:
                tokens.append(left + right)
    rng.shuffle(merges)
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
             "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
             "vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}
    path = tmp_path / "made.json"
    path.write_text(json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None, "model": model}))
    words = pairindex.Words(str(path))
    assert words.merges.early
    library = Tokenizer.from_file(str(path))
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(5)) for _ in range(200)]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text).ids
