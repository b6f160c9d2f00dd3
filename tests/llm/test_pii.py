"""Personal data: base spans against plain Python, the added ones by examples, the aggregation by votes of known makers."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from corpuslens.llm import pii
from corpuslens.llm.common import table

SCHEMA = "doc_id long, text string, found string, base_found int"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fits(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_of(text):
    return [(kind, m.start(), m.end()) for kind, p in BASE.items() for m in re.finditer(p, text or "") if fits(kind, m[0])]


def check(spark, rows):
    got = pii.report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        found = base_of(text)
        named = ",".join(":".join(map(str, s)) for s in found)
        expected.append((doc_id, *[sum(s[0] == k for s in found) for k in BASE], hashlib.sha256(named.encode()).hexdigest()))
        line = next(r for r in got if r["doc_id"] == doc_id)
        assert set(filter(None, named.split(","))) <= set(line["spans"].split(",")), text
    assert sorted(tuple(r)[:6] for r in got) == sorted(expected)
    return {r["doc_id"]: r for r in got}


def test_base_spans_equal_plain_python(spark):
    rng = random.Random(11)
    parts = ["a@b.co", "a@b.c_d@e.fr", "x@y", "@", ".", "..", "-", "_", "%", "+", " ", "  ", "\n", "é", "日", "😀", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5.6",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "5105105105105100", "+1 (437) 555-0689", "+44 20.7946-0958)",
             "+1", "+12345678", "123", "7", "(", ")", "word", "AKIA", "user.name+tag@mail-1.example.co.uk.", "12 34", "000.000.000.000"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(30))), "x", k) for k in range(1500)]
    rows += [(9001, None, None, 1), (9002, "", None, 1), (9003, " \n", "q", None)]
    check(spark, rows)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    check(spark, [(r["doc_id"], r["text"], "x", 1) for r in docs])


def test_long_texts(spark):
    """Runs that a scan from every place would read over and over, deep repetition, and many matches."""
    rows = [(1, "a" * 90_000, "", 1), (2, "1" * 90_000, "", 1), (3, "a@b" + ".c" * 30_000, "", 1), (4, "+1" * 15_000, "", 1),
            (5, "1." * 30_000, "", 1), (6, "x@y.zz " * 6_000, "", 1), (7, "4111 1111 1111 1111, " * 900, "", 1), (8, "1 " * 30_000, "", 1)]
    found = pii.candidates(spark.createDataFrame(rows, SCHEMA).repartition(8), column="spans").selectExpr(
        "doc_id", "transform(filter(spans, s -> s.base), s -> (s.rank, s.start, s.stop)) as base")
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in found.collect()}  # plain Python would take minutes on the same patterns
    assert {k for k in got if not got[k]} == {1, 2, 4, 8}
    assert got[3] == [(0, 0, 60_003)]
    assert got[5] == [(1, 8 * k, 8 * k + 7) for k in range(7_500)]
    assert got[6] == [(0, 7 * k, 7 * k + 6) for k in range(6_000)]
    assert got[7] == [(2, 21 * k, 21 * k + 19) for k in range(900)]


def test_added_spans(spark):
    """Other kinds count where their labelers agree; numbers of orders, versions and prices stay out."""
    private = {
        1: ("Mail me: jane.doe [at] example [dot] com today", "mail"), 2: ("call me at (437) 555-0689 or a@b.com", "tel"),
        3: ("SSN: 219-45-6789, born in May, a@b.com", "ssn"), 4: ("IBAN DE89 3704 0044 0532 0130 00 please", "iban"),
        5: ("ethernet mac 3c:22:fb:1a:9b:7e at 10.1.2.3", "mac"), 6: ("contact Dr. Maria Lopez, a@b.com", "person"),
        7: ("cards 4111111111111111 5105105105105100 and a@b.com", "grouped"),
    }
    clean = ["version 437.555.0689 of it", "ISBN 978-3-16-148410-0", "order 1234567890", "pages 12-34", "5949719 and 82", "a b c",
             "table 3.4 shows 1 000 000 rows", "v2001.100.200", "The Dr. is in", "12:34:56"]
    rows = [(k, t, None, 1) for k, (t, _) in private.items()] + [(100 + k, t, None, 1) for k, t in enumerate(clean)]
    got = check(spark, rows)
    for k, (text, kind) in private.items():
        assert f"{kind}:" in got[k]["spans"], (text, got[k])
    assert [got[100 + k]["spans"] for k in range(len(clean))] == [""] * len(clean)


def test_reliabilities_are_learned_from_votes_alone():
    rng = random.Random(3)
    right = [0.95, 0.9, 0.8, 0.7, 0.55, 0.5]
    counts = {}
    truth = {}
    for _ in range(20000):
        y = rng.random() < 0.6
        votes = tuple((1 if (rng.random() < p) == y else -1) if rng.random() < 0.8 else 0 for p in right)
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    patterns = [(0, v, n) for v, n in sorted(counts.items())]
    belief, table_of = pii.aggregate_votes(patterns)
    hits = sum(sum(y == (q > 0.5) for y in truth[v]) for (_, v, _), q in zip(patterns, belief, strict=True))
    assert hits / 20000 > 0.93
    learned = [table_of["email", n][0] / (0.8) for n in pii.LABELERS]
    assert all(abs(a - b) < 0.06 for a, b in zip(learned, right, strict=True))


def test_empty_and_no_candidates(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pii.report(none).collect() == []
    row = pii.report(spark.createDataFrame([(1, "nothing here", "x", 1)], SCHEMA)).first()
    assert row["spans"] == "" and row["score"] is None and row["added"] == 0


def test_candidates_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.com", "q", 5)], SCHEMA).withColumn("all_found", F.lit("z"))
    row = pii.candidates(docs, column="spans_of").first()
    assert (row["found"], row["base_found"], row["all_found"]) == ("q", 5, "z") and len(row["spans_of"]) == 1


def test_native(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = pii.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
