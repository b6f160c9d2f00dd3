import random
from datetime import timedelta

import pytest

from corpuslens.operators.ingest import append_keyed, rows_to_insert
from corpuslens.streaming.ingest import keyed_sink
from corpuslens.streaming.threads import thread_stream
from test_threads import LATE, SCHEMA, T0, at, expected


def drain(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_keyed_sink_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(40), i, f"v{i}") for i in range(300)]
    source, table, ckpt = (str(tmp_path / n) for n in ("source", "table", "ckpt"))
    schema = "k int, seq int, v string"
    for part in range(3):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        drain(keyed_sink(stream, table, ckpt, ["k"], ["seq"]).trigger(availableNow=True).start())
        return sorted(map(tuple, spark.read.schema(schema).parquet(table).collect()))

    first = run()
    assert {r[0] for r in first} == {k for k, _, _ in rows} and len(first) == len({r[0] for r in first})
    assert run() == first
    # a batch that is run again after a failure finds its keys there
    assert append_keyed(spark.createDataFrame(rows, schema), table, ["k"], ["seq"]) == 0


def test_keyed_append_twice_equals_once(spark, tmp_path):
    rows = [(1, 2, "late"), (1, 1, "early"), (2, 3, "x"), (2, 3, "x")]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    path = str(tmp_path / "t")
    assert append_keyed(df, path, ["k"], ["seq"]) == 2
    assert append_keyed(df, path, ["k"], ["seq"]) == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 1, "early"), (2, 3, "x")]
    assert rows_to_insert(df, df.limit(0), ["k"], ["seq"]).count() == 2


@pytest.mark.parametrize("compat", [True, False])
def test_thread_stream_equals_batch(spark, tmp_path, compat):
    rng = random.Random(5)
    rows, now = [], 0
    for tweet_id in range(1, 400):
        now += rng.choice([1, 10, 40, 200])
        more = int(rng.random() < 0.6)
        text = f"m{tweet_id}" + ("..." if more else "")
        rows.append((rng.randrange(1, 4), tweet_id, text, at(now), rng.random() < 0.1, more))
    source, ckpt = str(tmp_path / "source"), str(tmp_path / "ckpt")
    size = len(rows) // 4 + 1
    for part in range(4):  # shuffled inside a file: arrival order does not matter within the delay
        chunk = rows[part * size : part * size + size]
        rng.shuffle(chunk)
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    # two far-off messages push the watermark past everything else
    for extra in (0, 1):
        end = [(9, 10_000 + extra, "end", T0 + timedelta(days=5 + extra), False, 0)]
        spark.createDataFrame(end, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    name = f"threads_{compat}".lower()
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = thread_stream(stream, 120, "6 hours", compat)
    query = out.writeStream.format("memory").queryName(name).option("checkpointLocation", ckpt)
    drain(query.outputMode("append").trigger(availableNow=True).start())
    got = sorted(
        (r.author, r.end_id, r.text, r.t_start, r.t_end, r.is_rt) for r in spark.table(name).collect() if not r.late
    )
    # the batch form leaves a thread open at the end; the stream's timer closes it for age
    closing = [(a, 5_000, "z", T0 + timedelta(days=2), False, 0) for a in (1, 2, 3)]
    batch = [r for r in expected([(a, i, t, ts, rt, m) for a, i, t, ts, rt, m in rows + closing], 120, LATE, compat)
             if r[1] != 5_000]
    assert [r for r in got if r[0] != 9] == batch
    assert not [r for r in spark.table(name).collect() if r.late]


def test_late_messages_come_out_as_rejects(spark, tmp_path):
    source = str(tmp_path / "source")
    files = [[(1, 1, "a", at(0), False, 0)], [(1, 2, "b", at(10_000), False, 0)], [(1, 3, "old...", at(5), False, 1)],
             [(1, 4, "c", at(30_000), False, 0)]]
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = thread_stream(stream, 100, "100 seconds").writeStream.format("memory").queryName("late_rows")
    drain(query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    rows = {(r.end_id, r.late) for r in spark.table("late_rows").collect()}
    assert (3, False) not in rows and (1, False) in rows


def threads_of(spark, folder, files, latency, delay, name, **options):
    """The rows a stream gives out that takes one of the files a trigger, and the most states it held."""
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/source")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source")
    out = thread_stream(stream, latency, delay, **options)
    query = out.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/ckpt")
    query = query.outputMode("append").trigger(availableNow=True).start()
    drain(query)
    return spark.table(name).collect(), max(p.stateOperators[0].numRowsTotal for p in query.recentProgress)


def test_authors_share_states_and_threads_do_not_mix(spark, tmp_path):
    """A call per author costs far more than its messages, so the number of states must not grow with authors."""
    rng = random.Random(8)
    rows = []
    for k in range(600):
        more = int(rng.random() < 0.6)
        rows.append((rng.randrange(60), (1 << 60) + k, f"m{k}" + ("..." if more else ""), at(k * 3), rng.random() < 0.1, more))
    files = [rng.sample(rows[n : n + 200], 200) for n in (0, 200, 400)]
    files[0] += [(None, None, "nobody", at(1), False, 0), (None, (1 << 60) + 1, "somebody", at(2), None, 0)]
    files[0].append((7, (1 << 60) - 1, "no time", None, False, 0))
    ends = [[(99, 5_000 + n, "end", T0 + timedelta(days=5 + n), False, 0)] for n in (0, 1)]
    got, states = threads_of(spark, tmp_path, files + ends, 120, "1 hour", "shared_states", states=4)
    assert 1 < states <= 5  # one more is for messages without an author
    closing = [(a, (1 << 61), "z", T0 + timedelta(days=2), False, 0) for a in range(60)]
    batch = [r for r in expected(rows + closing, 120, LATE, False) if r[1] != 1 << 61]
    found = [(r.author, r.end_id, r.text, r.t_start, r.t_end, r.is_rt) for r in got if r.author != 99]
    nobody = {(None, None, "nobody", at(1), at(1), False), (None, (1 << 60) + 1, "somebody", at(2), at(2), False)}
    assert {r for r in found if r[0] is None} == nobody and not any(r.late for r in got)
    assert sorted(r for r in found if r[0] is not None) == batch


def test_rows_come_out_as_soon_as_the_watermark_is_past_them(spark, tmp_path):
    ms = timedelta(milliseconds=1)
    rows = [(1, 1, "a", at(400) - ms, False, 0), (2, 2, "b", at(400), False, 0), (3, 3, "c...", at(300), False, 1),
            (4, 4, "d...", at(300) + ms, False, 1)]
    got, _ = threads_of(spark, tmp_path, [rows, [(9, 9, "end", at(500), False, 0)]], 100, "100 seconds", "due_rows")
    assert {(r.end_id, r.text) for r in got} == {(1, "a"), (3, "c")}


@pytest.mark.parametrize("name", ["s09_stream_append", "s09_stream_feed"])
def test_stream_reads_a_table_of_several_files(spark, tmp_path, name):
    import __spark_entry__ as entry

    rows = [(n, f"text {n % 7}", "en", f"src{n % 9}", 6) for n in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    (tmp_path / "one").mkdir()
    docs.toPandas().to_parquet(tmp_path / "one" / "documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")

    def run(folder):
        return sorted(map(tuple, entry.queries()[name](spark, f"{tmp_path}/{folder}").collect()))

    assert run("many") == run("one") and {r[0] for r in run("many")} <= {r[0] for r in rows}
    assert len(run("many")) == len([r for r in rows if r[0] % 9 < 7])
    assert run("none") == []
