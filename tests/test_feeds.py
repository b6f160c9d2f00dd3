"""Loads that count once, prune their target and survive being broken off; page-wise reads; write-backs."""

import random

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import feeds
from corpuslens.session import shared_folder

SCHEMA = "k bigint, day string, text string, n int"
KEYS = ["k", "day"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, root):
    return sorted(map(tuple, feeds.loaded(spark, root, frame(spark, []).schema).collect()))


def test_a_batch_counts_once(spark):
    root = shared_folder(spark, "feed")
    first = frame(spark, [(1, "a", "x", 1), (1, "a", "y", 2), (2, "a", "z", 3), (None, "a", "q", 4)])
    rules = [F.when(F.col("k").isNull(), "null:k")]
    assert feeds.load(first, root, "b1", KEYS, ["n"], rules, slots=8) == (2, 2)
    assert feeds.load(first, root, "b1", KEYS, ["n"], rules, slots=8) == (2, 2)
    assert feeds.load(frame(spark, [(2, "a", "w", 5), (2, "b", "v", 6)]), root, "b2", KEYS, ["n"], rules, slots=8) == (1, 1)
    assert table(spark, root) == [(1, "a", "x", 1), (2, "a", "z", 3), (2, "b", "v", 6)]
    reasons = {(r["n"], r["reject_reason"], r["batch"]) for r in feeds.rejected(spark, root, first.schema).collect()}
    assert reasons == {(2, "duplicate_in_batch", "b1"), (4, "null:k", "b1"), (5, "exists", "b2")}


@pytest.mark.parametrize("broken_at", ["rejects", "batches", "rows"])
def test_a_batch_broken_off_leaves_nothing_and_runs_again(spark, monkeypatch, broken_at):
    root = shared_folder(spark, "feed")
    feeds.load(frame(spark, [(1, "a", "x", 1)]), root, "b1", KEYS, ["n"], slots=4)
    batch = frame(spark, [(1, "a", "x", 1), (5, "a", "y", 2), (6, "a", "z", 3)])
    writer = type(batch.write)
    write = writer.parquet

    def failing(self, path, *args, **kwargs):
        if f"{root}/{broken_at}" in path:
            raise OSError("lost")
        return write(self, path, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(writer, "parquet", failing)
        with pytest.raises(OSError):
            feeds.load(batch, root, "b2", KEYS, ["n"], slots=4)
    assert table(spark, root) == [(1, "a", "x", 1)]
    assert feeds.load(batch, root, "b2", KEYS, ["n"], slots=4) == (2, 1)
    assert table(spark, root) == [(1, "a", "x", 1), (5, "a", "y", 2), (6, "a", "z", 3)]


def test_an_append_reads_only_the_slots_of_its_keys(spark):
    """A target of any size is read only where the batch's keys lie."""
    read = {}
    for size in (400, 4000):
        root = shared_folder(spark, "feed")
        slots = size // 20  # as many rows a slot, whatever the size
        feeds.load(frame(spark, [(k, "a", "x", k) for k in range(size)]), root, "all", KEYS, ["n"], slots=slots)
        batch = frame(spark, [(7, "a", "x", 1), (10**6, "a", "new", 2), (11, "a", "x", 3)])
        met = feeds.met_rows(batch, root, KEYS, slots)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "slot" in plan.split("PartitionFilters: [")[1].split("]")[0]
        read[size] = met.count()
        assert feeds.load(batch, root, "more", KEYS, ["n"], slots=slots) == (1, 2)
    assert max(read.values()) < 150


def test_pages_are_read_up_to_the_first_known_entry(spark):
    rng = random.Random(3)
    for full in (None, 5):
        pages = {p: [f"{p}-{k}" for k in range(5)] for p in range(1, 40) if p != 4}
        known = {e for p in pages for e in pages[p] if p > 17 and rng.random() < 0.9} | {"13-2"}
        entries = spark.createDataFrame([(p, e) for p, some in pages.items() for e in some], "page int, tid string")
        there = spark.createDataFrame([(e,) for e in known], "tid string")
        got = sorted(r["tid"] for r in feeds.newer_pages(entries, there, ["tid"], full).collect())
        assert got == sorted(e for p in pages if p <= 13 for e in pages[p] if e not in known)
    nothing = feeds.newer_pages(entries.where("false"), there, ["tid"])
    assert nothing.collect() == [] and nothing.columns == ["page", "tid"]


def test_write_back_touches_only_what_changes(spark):
    path = shared_folder(spark, "published")
    rows = [(k, "a", "x", None if k % 2 else k) for k in range(500)]
    feeds.laid_out(frame(spark, rows), path, ["k"], 16)
    files = {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    changed = frame(spark, [(3, "a", "x", 1), (4, "a", "x", 4), (5, "a", "late", None), (10**9, "a", "not there", 1)])
    assert feeds.write_back(path, ["k"], changed, spark, 16) == 2
    now = spark.read.schema(changed.schema).parquet(path).drop("slot")
    assert sorted(map(tuple, now.collect())) == sorted(
        (3, "a", "x", 1) if r[0] == 3 else (5, "a", "late", None) if r[0] == 5 else r for r in rows)
    left = {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    assert len(files & left) >= len(files) - 2
    assert feeds.write_back(path, ["k"], changed, spark, 16) == 0
    assert {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()} == left
