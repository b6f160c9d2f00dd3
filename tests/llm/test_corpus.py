"""Operators that compare texts with each other, against brute force; the pipeline."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuslens.llm import decontaminate, neardups, substrings
from corpuslens.llm.common import table
from corpuslens.llm.components import components

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ASCII = bytes(range(128)).lower() + bytes(range(128, 256))


def shingles(text):
    words = (text or "").encode().translate(ASCII).split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(rows):
    sets, up = defaultdict(list), {i: i for i, _ in rows}
    for i, t in rows:
        sets[i].append(shingles(t))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(set)
    for i, some in sets.items():
        for s in some:
            for x in s:
                holders[x].add(i)
    for i in sets:
        for j in {j for s in sets[i] for x in s for j in holders[x] if j < i}:
            if any(100 * len(a & b) >= 85 * len(a | b) for a in sets[i] for b in sets[j] if a and b):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in up}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    docs += [(10_000 + k, edited(rng, base, rng.choice([1, 2, 3, 4, 5, 8]))) for k in range(250)]
    chain = list(base)
    for k in range(30):  # each a link of the one before, ends far apart
        chain[5 * k:5 * k + 3] = [f"c{k}a", f"c{k}b", f"c{k}c"]
        docs.append((20_000 + k, " ".join(chain)))
    docs += [(30_000, ""), (30_001, None), (30_002, "  "), (30_003, "one two"), (30_004, "ONE  two"), (30_005, "two one")]
    docs += [(30_006, "One\ttwo"), (30_007, docs[0][1]), (30_007, "one two"), (30_008, docs[1][1]), (30_008, docs[1][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in neardups.link(frame).collect()}
    want = brute_components(docs)
    assert {i: r["component_id"] for i, r in out.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in out.items())
    assert all(out[i]["n_shingles"] == len(shingles(t)) for i, t in docs if i != 30_007)


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(neardups, "CHUNK", 20)
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    docs = [(k, edited(rng, base, rng.choice([1, 2, 3, 6]))) for k in range(300)]
    out = neardups.link(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == brute_components(docs)


def test_near_duplicates_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert neardups.link(none).count() == 0 and neardups.deduplicated(none).columns == none.columns
    odd = spark.createDataFrame([(None, "a b c", "x", None, 1), (None, "a b c", "x", None, 1), (3, None, None, None, None)], SCHEMA)
    assert [r["kept"] for r in neardups.link(odd).collect()] == [True] * 3
    assert neardups.deduplicated(odd).count() == 3


def test_one_row_of_a_group_stays_with_all_columns(spark):
    text = "a b c d e f g h"
    frame = spark.createDataFrame(
        [(5, text, 1, "x", 0), (2, text, 2, "y", 0), (2, text, 2, "y", 0), (9, "other words here", 3, "z", 0)],
        "doc_id long, text string, n int, component string, key int")
    assert sorted(map(tuple, neardups.deduplicated(frame).collect())) == [(2, text, 2, "y", 0), (9, "other words here", 3, "z", 0)]


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(100)] + [(500, 400), (400, 500), (7, 7), (900, 901)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(101)}, 400: 400, 500: 400, 900: 900, 901: 900}


def test_tables_are_square_of_hashes():
    assert neardups.HASHES == 2 * neardups.HALVES * neardups.ROWS
    s = 0.85
    assert 1 - (1 - (1 - s ** neardups.ROWS) ** neardups.HALVES) ** 2 < 4e-4


def test_decontamination_finds_edited_items_and_nothing_else(spark):
    rng = random.Random(6)
    items = table(spark, SF, "benchmark")
    known = [(r["item_id"], r["text"]) for r in items.collect()]
    hosts = [r["text"].split() for r in table(spark, SF, "documents").collect()]
    hosts = [h for h in hosts if not any(" ".join(t.split()) in " ".join(h) for _, t in known)]
    vocabulary = [w for h in hosts for w in h]
    rows, planted = [], {}
    for k in range(400):
        item, text = rng.choice(known)
        words, most = text.split(), decontaminate.edits_allowed(len(decontaminate.word_codes(text)), 0.2)
        for _ in range(rng.randint(0, min(5, most))):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(vocabulary)]])
        host = rng.choice(hosts)
        at = rng.randrange(len(host) + 1)
        rows.append((k, " ".join(host[:at] + words + host[at:])))
        planted[k] = item
    rows += [(1000 + k, " ".join(h)) for k, h in enumerate(hosts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = decontaminate.scan(docs, items).collect()
    found = {(r["doc_id"], r["item_id"]) for r in out}
    assert sum((k, i) in found for k, i in planted.items()) >= 0.98 * len(planted)
    codes = {i: decontaminate.word_codes(t) for i, t in known}
    texts = dict(rows)
    for r in out:  # every row is a real match at its offsets
        piece = decontaminate.word_codes(texts[r["doc_id"]][r["start"]:r["stop"]])
        assert decontaminate.best_match(codes[r["item_id"]], piece)[0] == r["distance"] <= 0.2 * r["item_words"]
    assert len({r["doc_id"] for r in out if r["doc_id"] >= 1000}) <= 2
    assert decontaminate.clean(docs, items).count() == len(rows) - len({r["doc_id"] for r in out})


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_best_match_is_exact():
    import numpy as np

    rng = np.random.default_rng(7)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 7)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64)
        distance, start, stop = decontaminate.best_match(a, b)
        want = min(plain_distance(a.tolist(), b[i:j].tolist()) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert distance == want == plain_distance(a.tolist(), b[start:stop].tolist())


def test_decontamination_edge_cases(spark):
    items = spark.createDataFrame([(1, None), (2, "one two three four five"), (None, "a b"), (2, "one two three four five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "zero ONE, two! three four\nfive."), (4, "one two")], "doc_id long, text string")
    rows = [tuple(r) for r in decontaminate.scan(docs, items).collect()]
    assert rows == [(None, 2, 5, 30, 0, 5)] * 2
    assert decontaminate.scan(docs, items.where("false")).count() == 0
    assert decontaminate.scan(docs.where("false"), items).count() == 0
    assert decontaminate.clean(docs, items).count() == 3


def test_repeats_edge_cases(spark):
    passage = " ".join(f"word{k}" for k in range(40)) + "."
    rows = [(1, f"Intro here. {passage} End."), (2, f"Other start, {passage.upper()} Stop."), (3, f"x. {passage}"),
            (None, f"y. {passage}"), (4, None), (5, ""), (6, "Short. Short. Short."), (3, f"x. {passage}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = substrings.repeats(frame).collect()
    assert sorted((r["doc_id"] or -1, r["first_doc_id"]) for r in out) == [(-1, 1), (3, 1), (3, 3)]  # the last run opens with a unit first met in 3
    lines = substrings.repeats(spark.createDataFrame([(1, "a b\nc d\na  B\n"), (2, "c d\ne f")], "doc_id long, text string"), substrings.LINES, 1)
    assert sorted((r["doc_id"], r["start"], r["stop"], r["first_doc_id"]) for r in lines.collect()) == [(1, 8, 13, 1), (2, 0, 4, 1)]
    assert substrings.repeats(frame.where("false")).count() == 0


def test_passages_begin_and_end_anywhere(spark):
    two = " ".join(f"a{k}" for k in range(28)) + ". " + " ".join(f"b{k}" for k in range(28))
    plain, short = " ".join(f"c{k}" for k in range(60)), " ".join(f"d{k}" for k in range(29))
    host = [" ".join(f"{x}{k}" for k in range(40)) for x in "pqrstuvw"]
    twice = " ".join(f"e{k}" for k in range(35))
    texts = [f"{host[0]} {two} {host[1]}", f"{host[2]} {two.upper()}\n{host[3]}", f"{host[4]} {plain} {host[5]}", f"é {host[6]}  {plain} {host[7]}.",
             f"x {short} y", f"z {short} w", None, "", f"{twice} - {twice}", " ".join(["again"] * 100), plain]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in substrings.passages(frame).collect()}
    assert sorted(out) == [1, 3, 8, 9, 10]
    cut = {k: texts[k][r["start"]:r["stop"]] for k, r in out.items()}
    assert cut == {1: two.upper(), 3: plain, 8: twice, 9: " ".join(["again"] * 80), 10: plain}
    assert [(out[k]["first_doc_id"], out[k]["words"]) for k in sorted(out)] == [(0, 56), (2, 60), (8, 35), (9, 80), (2, 60)]
    assert all(texts[r["first_doc_id"]][r["first_start"]:].lower().startswith(cut[k].lower()[:50]) for k, r in out.items())
    assert substrings.passages(frame.where("false")).count() == 0
    assert not {1, 3} & {r["doc_id"] for r in substrings.repeats(frame).collect()}


def test_passages_of_random_lengths_are_found(spark):
    rng = random.Random(5)
    texts, want = [], {}
    for k in range(0, 200, 2):
        n = rng.randrange(30, 120)
        words = [[f"w{rng.randrange(10**9)}" for _ in range(m)] for m in (n, *(rng.randrange(60) for _ in range(4)))]
        texts += [" ".join(words[1] + words[0] + words[2]), " ".join(words[3] + words[0] + words[4])]
        if k % 3 == 0:  # the whole text is a copy, nothing stands beside it
            texts[-1] = " ".join(words[0])
        want[k + 1] = (n, " ".join(words[0]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: (r["words"], texts[r["doc_id"]][r["start"]:r["stop"]]) for r in substrings.passages(frame).collect()} == want


def test_pipeline_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "benchmark_decontamination", "secret_scans", "mix_sources"]
    docs, steps = table(spark, SF, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        steps.append((name, docs.count()))
        assert name == "mix_sources" or docs.columns == columns
    counts = dict(steps)
    assert 1000 > counts["quality_rules"] > counts["near_dedup"] > counts["benchmark_decontamination"]
    assert counts["benchmark_decontamination"] == counts["secret_scans"] == counts["mix_sources"]
    assert docs.columns == [*columns, "size", "source_size", "target", "copies", "taken"]
    got = {r["doc_id"]: r for r in docs.collect()}
    assert all(r["text"] and r["size"] == len(r["text"].encode().split()) for r in got.values())
    assert sorted(docs.drop("text").collect()) == sorted(corpus_pipeline.run(spark, SF).drop("text").collect())


def test_pipeline_with_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "x " * 200, "en", None, 3)]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"label": F.lit(1), "row": F.lit("x"), "component": F.lit(2)})
    for docs in (extra, extra.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            assert name == "mix_sources" or out.columns == docs.columns


def test_dedup_keeps_unlinked_texts_of_a_repeated_id(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    rows = [(1, a, "x", "s", 1), (1, b, "x", "s", 1), (2, b, "x", "s", 1), (2, a + " end", "x", "s", 1), (2, "lone text of its own", None, None, 0),
            (3, b, "x", "s", 1), (None, a, None, None, None), (None, a, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("mine"))
    got = sorted((r["doc_id"] or 0, r["text"]) for r in neardups.deduplicated(docs).collect())
    assert got == sorted([(0, a), (0, a), (1, a), (1, b), (2, "lone text of its own")])


def test_words_of_very_long_texts_stay_whole(spark):
    rows = [(1, "\r".join(f"w{k}" for k in range(300_000)), None, None, 0), (2, ",".join(f"w{k}" for k in range(300_000)), None, None, 0),
            (3, "a b c d e f " + "x" * 2_500_000 + " g h", None, None, 0)]
    got = {r["doc_id"]: r["n_shingles"] for r in neardups.link(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 299_996, 2: 1, 3: 5}


def test_benchmark_items_in_long_unspaced_and_short_texts(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    chinese = "\u6211\u4eec\u7684\u8bad\u7ec3\u6570\u636e\u91cc\u4e0d\u5e94\u8be5\u51fa\u73b0\u8fd9\u4e00\u53e5\u8bdd\u56e0\u4e3a\u5b83\u662f\u8bc4\u6d4b\u9898\u76ee"
    many = ",".join(f"w{k}" for k in range(400_000))
    texts = {1: f"{many} {item}", 2: f"{many} {item} tail,of the text", 3: f"\u524d{chinese}\u540e", 4: "the Grail-Quest, again", 5: "the grail, a quest", 6: "\u6211\u4eec"}
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in texts.items()], SCHEMA)
    items = spark.createDataFrame([(10, item), (11, chinese), (12, "Grail quest"), (13, ""), (14, None)], "item_id long, text string")
    found = decontaminate.scan(docs, items).collect()
    got = {(r["doc_id"], r["item_id"]): texts[r["doc_id"]][r["start"]:r["stop"]] for r in found}
    assert got == {(1, 10): item, (2, 10): item, (3, 11): chinese, (4, 12): "Grail-Quest"}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [5, 6]
