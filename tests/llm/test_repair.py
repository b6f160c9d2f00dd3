"""Conversation repair against a search over all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from corpuslens.llm import repair
from corpuslens.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, fault string, conv long"
GOAL = re.compile("(s?(ua)+)?")
ROLES = {"user": "u", "assistant": "a"}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kept = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else None if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def search(rows, faults):
    """Least (cost, letters) with the repaired rows, by trying every edit from the front with at most two insertions a place."""
    best = {"": (0, "", ())}  # role initials so far -> cheapest

    def keep_better(out, initials, way):
        if re.fullmatch("(s?(ua)*u?)?", initials) and (initials not in out or way[:2] < out[initials][:2]):
            out[initials] = way

    def inserted(ways):
        out = dict(ways)
        for _ in range(2):
            for initials, (cost, letters, kept) in list(out.items()):
                for role, i in ROLES.items():
                    keep_better(out, initials + i, (cost + 2, letters + "I", (*kept, (role, ""))))
        return out

    for (_, role, text), fault in zip(rows, faults, strict=True):
        out = {}
        extra = fault == "truncated"
        for initials, (cost, letters, kept) in inserted(best).items():
            keep_better(out, initials, (cost + 3, letters + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1]:
                keep_better(out, initials + role[:1], (cost + extra, letters + "K", (*kept, (role, text))))
            for new, i in ROLES.items():
                keep_better(out, initials + i, (cost + 2 + extra, letters + "R", (*kept, (new, text))))
        best = out
    return min((way for initials, way in inserted(best).items() if GOAL.fullmatch(initials)), key=lambda w: w[:2])


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = faults_of(rows)
    cost, letters, kept = search(rows, faults)
    turns = [t for t, *_ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        yield from [(conv, turn, role, text)] * (2 if hit == 3 else 1)


def all_expected(rows, ids):
    found = {i: [] for i in ids}
    for conv, *row in rows:
        found[conv].append(tuple(row))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {i: expected(some) if some else empty for i, some in found.items()}


def got_rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_repairs_equal_a_search(spark):
    rng = random.Random(8)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system"] * 2 + ["tool", "", None, "User", "u", "sys"]
    texts = ["Yes.", "No!", "cut", "ok?\n", "", " \t", None, "é.", "日本", "a\nb."]
    rows = [
        (c, rng.choice([None, t, t, t, t + 1, t * 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}" + rng.choice([".", "", "!"]))
        for c in [*range(400), None] for t in range(rng.randrange(1, 9))]
    rows += [(500, -5, "user", "Hi."), (501, 2**62, "assistant", "Hi."), (501, -(2**62), "user", "Hi.")]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(6)
    ids = {r[0] for r in rows}
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got_rows(repair.repair_report(docs, docs)) == all_expected(plain, ids)
    assert got_rows(repair.repair_report(docs, repair.damaged(docs))) == all_expected(damage(rows), ids)


@pytest.mark.parametrize("batch", [3, 10000])
def test_whole_table_and_batches(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        turns = table(spark, "/root/testdata/sf0.01", "conversations")
        rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
        got = got_rows(repair.repair_report(turns, repair.damaged(turns)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == all_expected(damage(rows), {r[0] for r in rows})


def test_giant_conversation(spark):
    """50,000 turns in many batches: every pair of turns lacks its answer at one place."""
    rows = [(1, t, "user" if t % 5 in (0, 2, 4) else "assistant", f"text {t}.", None, 1) for t in range(50_000)]
    df = repair.repair_report(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA))
    row = df.first()
    assert row["audit"] == "KKKKKI" * 10_000
    assert row["cost"] == 20_000 and row["illegal"] == 9_999


def test_edits_hold_the_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind.", None, 0), (1, 1, "assistant", "Hello.", None, 0), (1, 2, "assistant", "Hello.", None, 0)]
    got = [tuple(r) for r in repair.edits(spark.createDataFrame(rows, SCHEMA)).orderBy("at").collect()]
    assert got == [
        (1, 0, "K", 0, "system", "Be kind.", "system", None), (1, 1, "I", None, "user", "", None, None),
        (1, 2, "K", 1, "assistant", "Hello.", "assistant", None), (1, 3, "D", 2, "assistant", "Hello.", "assistant", "duplicate")]


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(none, none).collect() == []


def test_one_exchange(spark):
    turns = table(spark, "/root/testdata/sf0.001", "conversations")
    plan = repair.report(repair.edits(turns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
