"""Phrase collocations against a plain count of all n-grams."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.llm import collocations

SCHEMA = "doc_id long, text string, lang string, f long, chunk string"
LOWER = bytes(range(128)).lower() + bytes(range(128, 256))


def brute(rows, least, top):
    f, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = (text or "").encode().translate(LOWER).decode()
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            sizes[lang] += len(words)
            for n in range(1, 5):
                f.update((lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    phrases = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    out = {}
    for (lang, *words), a in phrases.items():
        cuts = [(2000000 * a // (f[(lang, *words[:k])] + f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        whole = max((c for p, c in phrases.items() if p[0] == lang and len(p) > len(words) + 1
                     and any(list(p[i:i + len(words)]) == words for i in range(1, len(p)))), default=0)
        if 100 * whole < 80 * a:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, sizes[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def texts(rng):
    words = ["a", "B", "the", "é", "日本", "x-y", "w\x00", " ", "ZZ", "q"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r", "\x0b", "!"]
    stock = "the Quick brown fox jumps over the lazy dog and then sleeps all day long in the sun"
    out = [(1, None, None), (2, "", "en"), (3, " \t . ", "en"), (4, "one", "en")]
    for k in range(300):
        body = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60)))
        out.append((k % 200, body + stock * rng.randrange(3), rng.choice(["en", "de", None, "und"])))
    out.append((999, "same " * 5000, "de"))
    out.append((1000, "".join(f"w{rng.randrange(40)} " for _ in range(20000)), "en"))
    return [(*row, 7, "extra") for row in out]


@pytest.mark.parametrize("every", [2, 16])
def test_collocations_equal_a_plain_count(spark, every):
    rows = texts(random.Random(5))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = collocations.collocations(docs, least=8, top=150, every=every, salts=4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 8, 150)


def test_chunks_cover_every_word_once(spark):
    docs = spark.createDataFrame(texts(random.Random(6)), SCHEMA)
    chunks = collocations.dictionary(docs, 4)
    got = {(r["lang"], r["phrase"]): r["f"] for r in collocations.counts(chunks, 1).collect()}
    expected = Counter()
    for _, text, lang, *_ in docs.collect():
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").encode().translate(LOWER).decode()):
            expected.update((lang or "und", w) for w in re.split("[\x20\x09]+", piece) if w)
    assert got == expected
    assert chunks.groupBy().agg({"n": "max"}).first()[0] > 100  # copies meet in the dictionary


def test_slabs_keep_rows_and_order():
    sizes = [0, 5, 30, 0, 1, 1, 12, 9, 0]
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * n for n in part]}) for part in (sizes[:4], [], sizes[4:]) if part]
    slabs = list(collocations._slabs(iter(batches), "text", 10))
    assert [len(t) for s in slabs for t in s.column("text").to_pylist()] == sizes
    assert all(s.num_rows == 1 or sum(map(len, s.column("text").to_pylist())) <= 10 for s in slabs)


def test_no_documents(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_past_64_bits_of_a_product(spark):
    """A dictionary row stands for any number of places; scores multiply them by two million."""
    n = 1 << 50
    chunks = spark.createDataFrame([("en", True, "a b", n), ("en", True, "a c", n // 3)], "lang string, last boolean, chunk string, n long")
    levels = [collocations.counts(chunks, k) for k in (1, 2)]
    frequent = levels[0].union(levels[1])
    phrases = levels[1].selectExpr("*", "2 as words")
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["score"]) for r in collocations._scored(phrases, frequent).collect()}
    for phrase, a, r in (("a b", n, n), ("a c", n // 3, n // 3)):
        left = n + n // 3
        assert got[phrase] == (a, left, r, 2000000 * a // (left + r))


def test_rare_phrases_are_not_counted_as_text(spark):
    """Most pairs of words are rare: they are told apart by hash, so that their texts aren't made, dealt out and summed up."""
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(300)}" for _ in range(400)) + " the same four words.", "en", 0, "") for k in range(60)]
    chunks = collocations.dictionary(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()
    every = {(r["lang"], r["phrase"]): r["f"] for r in collocations.counts(chunks, range(1, 5)).collect()}
    known = collocations.frequent_hashes(chunks, 30)
    got = {(r["lang"], r["phrase"]): r["f"] for r in collocations.counts(chunks, range(1, 5), known).collect()}
    frequent = {p for p, f in every.items() if f >= 30}
    assert sum(len(p.split()) > 1 for _, p in frequent) >= 6 and len(every) > 40000
    assert all(got[p] == every[p] for p in frequent)
    assert len(got) < len(frequent) + len(every) / 20
    assert chunks.groupBy("lang").sum("words").collect() == [("en", 60 * 404)]


def test_equal_hashes_of_other_words_change_no_count(monkeypatch):
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["en", "de", "en"], "last": [True, True, False], "chunk": ["a b a", "a b", "b a c d e"], "n": [2, 3, 5]})

    def grams():
        slab = [r for n in (1, 2, 3, 4) for b in collocations._grams(batch, [n], known) for r in b.to_pylist()]
        return {(r["lang"], r["phrase"]): r["f"] for r in slab}

    known = {}
    expected = grams()
    assert expected["en", "a"] == 4 + 5 and expected["en", "b a"] == 2 + 5 and expected["de", "a b"] == 3 and ("en", "c") not in expected
    monkeypatch.setattr(collocations, "_word_codes", lambda b, start, stop: np.zeros(len(start), np.uint64))
    monkeypatch.setattr(collocations, "_lang_codes", lambda langs: np.zeros(len(langs), np.uint64))
    known = {n: collocations.Filter(np.full(16, (1 << 64) - 1, np.uint64)) for n in (1, 2, 3, 4)}
    assert grams() == expected


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    words = [b"a", b"b", b"ab", b"ba", b"a\x00", b"\x00", b"x" * 9, b"y" * 40, "\u00e9".encode()]

    def codes(order):
        text = b" ".join(words[k] for k in order)
        stop = np.cumsum([len(words[k]) + 1 for k in order]) - 1
        start = stop - [len(words[k]) for k in order]
        return collocations._word_codes(np.frombuffer(text, np.uint8), start, stop)

    rng = random.Random(8)
    for block in (1 << 18, 32):  # the longest word is past the smaller block
        monkeypatch.setattr(collocations, "BLOCK", block)
        collocations._powers.cache_clear()
        order = [rng.randrange(len(words)) for _ in range(500)]
        pairs = set(zip(order, codes(order).tolist(), strict=True))
        assert len(pairs) == len(set(order)) == len({c for _, c in pairs}) == len(words)
    collocations._powers.cache_clear()
    assert len(codes([])) == 0


def test_buckets_meet_across_batches():
    def packed(rows):
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([b for b, _, _ in rows], pa.int32()), "codes": [np.array(c, np.uint64).tobytes() for _, c, _ in rows],
            "times": [np.array(t, np.int64).tobytes() for _, _, t in rows]})

    batches = [packed([(1, [5, 7], [1, 2])]), packed([(1, [7], [4]), (1, [6], [1]), (3, [9], [8])]), packed([(3, [9], [1])])]
    got = [(c.tolist(), t.tolist()) for c, t in collocations._buckets(iter(batches))]
    assert got == [([5, 6, 7], [1, 1, 6]), ([9], [9])]
    assert [c.tolist() for c, _ in collocations._buckets(iter(batches[:1]))] == [[5, 7]] and not list(collocations._buckets(iter([])))
