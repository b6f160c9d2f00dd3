import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpuslens.operators.threads import build_threads, own_messages, with_segments

T0 = datetime(2024, 1, 1)
SCHEMA = "author bigint, tweet_id bigint, text string, ts timestamp, is_rt boolean, more int"


def dots(text):
    return text.lstrip(".").strip() if text.startswith("..") else text.strip()


def sequential(rows, latency, now, compat):
    """The rules, one message after the other, for one author."""
    out, start, first, last, joined = [], None, None, None, ""
    for tweet_id, text, ts, is_rt, more in sorted(rows):
        if is_rt:
            out.append((tweet_id, text, ts, ts, True))
            continue
        text = dots(text)
        piece = text.rstrip(".").strip() if text.endswith("..") else text
        if start is not None and (ts - start).total_seconds() < latency:
            joined, last = joined + " " + piece, (tweet_id, ts)
            if not more:
                out.append((tweet_id, joined, start, ts, False))
                start = None
            continue
        if start is not None:
            end = first if compat else last
            out.append((end[0], joined, start, end[1], False))
            start = None
        if not more:
            out.append((tweet_id, text, ts, ts, False))
        elif ts > now - timedelta(seconds=latency):
            break
        else:
            start, first, last, joined = ts, (tweet_id, ts), (tweet_id, ts), " " + piece
    return [(i, t if compat or rt else t.strip(), a, b, rt) for i, t, a, b, rt in out]


def run(spark, rows, latency, now, compat):
    df = spark.createDataFrame([(a, i, t, ts, rt, m) for a, i, t, ts, rt, m in rows], SCHEMA).repartition(4)
    got = build_threads(df, latency, now, compat).collect()
    return sorted((r.author, r.end_id, r.text, r.t_start, r.t_end, r.is_rt) for r in got)


def expected(rows, latency, now, compat):
    out = []
    for author in {r[0] for r in rows}:
        own = [(i, t, ts, rt, m) for a, i, t, ts, rt, m in rows if a == author]
        out += [(author, *r) for r in sequential(own, latency, now, compat)]
    return sorted(out)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


LATE = T0 + timedelta(days=30)


@pytest.mark.parametrize(
    "rows, result",
    [
        # a message without dots stands alone; a repost passes through and leaves an open thread alone
        ([(1, 1, "one", at(0), False, 0)], [(1, 1, "one", at(0), at(0), False)]),
        (
            [(1, 1, "a...", at(0), False, 1), (1, 2, "rt", at(5), True, 0), (1, 3, "...b", at(9), False, 0)],
            [(1, 2, "rt", at(5), at(5), True), (1, 3, " a b", at(0), at(9), False)],
        ),
        # the age counts from the thread's start, and a thread closed by age keeps its first id and time
        (
            [(1, 1, "a...", at(0), False, 1), (1, 2, "b...", at(60), False, 1), (1, 3, "c", at(100), False, 0)],
            [(1, 1, " a b", at(0), at(0), False), (1, 3, "c", at(100), at(100), False)],
        ),
        # a thread still open at the end is not given out
        ([(1, 1, "a", at(0), False, 0), (1, 2, "b...", at(1), False, 1)], [(1, 1, "a", at(0), at(0), False)]),
        # ids decide the order, not times of arrival
        ([(1, 2, "b", at(9), False, 0), (1, 1, "a...", at(0), False, 1)], [(1, 2, " a b", at(0), at(9), False)]),
    ],
)
def test_rules(spark, rows, result):
    assert run(spark, rows, 100, LATE, True) == result


def test_corrected_mode_keeps_the_last_id(spark):
    rows = [(1, 1, "a...", at(0), False, 1), (1, 2, "b...", at(60), False, 1), (1, 3, "c", at(100), False, 0)]
    got = run(spark, rows, 100, LATE, False)
    assert got == [(1, 2, "a b", at(0), at(60), False), (1, 3, "c", at(100), at(100), False)]


def test_young_thread_holds_back_its_author_only(spark):
    rows = [
        (1, 1, "a", at(0), False, 0), (1, 2, "b...", at(950), False, 1), (1, 3, "rt", at(960), True, 0),
        (1, 4, "c", at(970), False, 0), (2, 5, "d", at(980), False, 0),
    ]
    got = run(spark, rows, 100, at(1000), True)
    assert got == [(1, 1, "a", at(0), at(0), False), (2, 5, "d", at(980), at(980), False)]


@pytest.mark.parametrize("compat", [True, False])
@pytest.mark.parametrize("seed, ranges", [(1, 1), (2, 4), (3, 13)])
def test_equals_sequential_rules(spark, seed, ranges, compat):
    rng = random.Random(seed)
    rows, now = [], 0
    for tweet_id in range(1, 1500):
        now += rng.choice([1, 10, 40, 200])
        author = 1 if rng.random() < 0.5 else rng.randrange(2, 6)  # one hot author
        more, cont = int(rng.random() < 0.6), rng.random() < 0.4
        text = ("..." if cont else "") + f"m{tweet_id}" + ("..." if more else "")
        rows.append((author, tweet_id * 7, text, at(now), rng.random() < 0.15, more))
    end = at(now - 300)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert run(spark, rows, 120, end, compat) == expected(rows, 120, end, compat)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


@pytest.mark.parametrize("compat", [True, False])
def test_times_that_run_backwards(spark, compat):
    """Ids decide the order; a stretch ends only where a message is late after all before it."""
    rng = random.Random(5)
    rows = [(1 + k % 2, k, f"m{k}" + ("..." if rng.random() < 0.7 else ""), at(k * 20 + rng.randrange(-300, 300)), False, 0) for k in range(600)]
    rows = [(a, i, t, ts, rt, int(t.endswith("..."))) for a, i, t, ts, rt, _ in rows]
    assert run(spark, rows, 100, LATE, compat) == expected(rows, 100, LATE, compat)


def test_an_author_who_always_ends_in_dots_is_split(spark):
    rows = [(1, k, f"m{k}...", at(1000 * (k // 4) + k % 4), False, 1) for k in range(400)]
    own = own_messages(spark.createDataFrame(rows, SCHEMA)).withColumn("ts", F.unix_micros("ts"))
    sizes = with_segments(own, 100 * 10**6).groupBy("seg").count().collect()
    assert len(sizes) == 100 and {r["count"] for r in sizes} == {4}
    assert len(run(spark, rows, 100, LATE, False)) == 99  # the last is still open
