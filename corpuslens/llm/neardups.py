"""MinHash near-dedup with tensored banding: table keys are pairs from two small collections of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import map_texts, stored, strings, texts_of
from corpuslens.llm.components import components
from corpuslens.llm.subwords import hash_words
from corpuslens.plans.ranks import global_rank

SHINGLE = 5
HALVES, ROWS = 12, 4  # two collections of HALVES hashes of ROWS minhashes each: 96 minhashes give 144 tables of 8
HASHES = 2 * HALVES * ROWS
LINK = (85, 100)
BITS = 2048
CHUNK = 1500

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[[9, 10, 11, 12, 13]] = 32
_FOLDED[ord("A"):ord("Z") + 1] += 32
_RNG = np.random.default_rng(2718)
_FLIP = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ODD = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(28))) * _ODD[0]
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """The text's set: distinct 64-bit hashes of 5 words in a row; of all words if there are fewer."""
    words = hash_words(text, _FOLDED)
    n = len(words)
    if not n:
        return words
    if n < SHINGLE:
        return _mixed((words * _ODD[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    codes = words[:n - SHINGLE + 1] * _ODD[0]
    for k in range(1, SHINGLE):
        codes = codes + words[k:n - SHINGLE + 1 + k] * _ODD[k]
    return np.unique(_mixed(codes))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted, distinct) share 85 of 100 members of their union."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or LINK[1] * len(small) < LINK[0] * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return LINK[1] * both >= LINK[0] * (len(a) + len(b) - both)


def parities(codes: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of the members hashed to it.

    Two sets' bits differ in at most as many places as the sets have members that are not shared.
    """
    return np.packbits(np.bincount((codes >> np.uint64(5)).astype(np.int64) % BITS, minlength=BITS).astype(np.uint8) & 1)


def minhashes(codes: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.uint32(0xFFFFFFFF))
    x = (codes >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(x), 4096):
        low = np.minimum(low, ((x[k:k + 4096, None] ^ _FLIP) * _TIMES).min(axis=0))
    return low


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, digest1, digest2, sketches, halves = [], [], [], [], []
    for text in texts_of(batch):
        codes = shingles(text)
        sizes.append(len(codes))
        digest1.append(np.add.reduce(codes))
        digest2.append(np.add.reduce(_mixed(codes ^ _ODD[1])))
        low = minhashes(codes)
        sketches.append(parities(codes).tobytes())
        parts = low.reshape(2 * HALVES, ROWS).astype(np.uint64)
        halves.append(_mixed((parts * _ODD[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(2 * HALVES, dtype=np.uint64)))
    as_long = lambda x: pa.array(np.array(x, np.uint64).astype(np.int64))
    flat = np.concatenate(halves).astype(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * 2 * HALVES), pa.array(flat))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes, pa.int64()), as_long(digest1), as_long(digest2), pa.array(sketches, pa.binary()), lists],
        ["doc_id", "n", "digest1", "digest2", "sketch", "halves"])


SKETCH_SCHEMA = "doc_id long, n long, digest1 long, digest2 long, sketch binary, halves array<long>"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows with equal key and part, from batches sorted by them."""
    held: list[list[np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(5)]
        cols.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(-1, BITS // 64))
        edge = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
        for lo, hi in zip(np.r_[0, edge], np.r_[edge, batch.num_rows], strict=True):
            piece = [c[lo:hi] for c in cols]
            key = piece[0][0], piece[1][0]
            if held and key != last:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            last = key
            held.append(piece)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _close(sizes: np.ndarray, sketches: np.ndarray, k: int) -> np.ndarray:
    """How alike each row is to row ``k`` by parities; -1 where sizes or parities prove that they aren't linked."""
    total = sizes + sizes[k]
    apart = np.bitwise_count(sketches ^ sketches[k]).sum(axis=1, dtype=np.int64)
    more, less = LINK[1] + LINK[0], LINK[1] - LINK[0]  # links have at most less / more of both sizes unshared
    may = (apart * more <= total * less) & (LINK[1] * np.minimum(sizes, sizes[k]) >= LINK[0] * np.maximum(sizes, sizes[k]))
    return np.where(may, 1 - apart / np.maximum(1, total), -1.0)


def _tree(cols: list[np.ndarray]) -> list[tuple[int, int]]:
    """Likeliest links that join the bucket: a maximum spanning forest by likeness."""
    docs, sizes, sketches = cols[2], cols[3], cols[5]
    n = len(docs)
    best, parent, open_ = np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    k, out = 0, []
    for _ in range(n - 1):
        open_[k] = False
        near = _close(sizes, sketches, k)
        better = open_ & (near > best)
        best[better], parent[better] = near[better], k
        k = int(np.where(open_, best, -2.0).argmax())
        if best[k] >= 0:
            out.append((int(docs[k]), int(docs[parent[k]])))
    return out


def _across(cols: list[np.ndarray]) -> list[tuple[int, int]]:
    """All pairs of the bucket that may be links and lie in different components."""
    docs, sizes, found, sketches = cols[2], cols[3], cols[4], cols[5]
    out = []
    for k in range(len(docs) - 1):
        may = (_close(sizes[k:], sketches[k:], 0) >= 0) & (found[k:] != found[k])
        out += [(int(docs[k]), int(d)) for d in docs[k:][may]]
    return out


def _pairs(rows: DataFrame, choose) -> DataFrame:
    """Distinct pairs a < b that ``choose`` takes from each group of rows of one key and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[int, int]] = set()
        for cols in _groups(batches):
            held.update((min(p), max(p)) for p in choose(cols) if p[0] != p[1])
            if len(held) >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], ["a", "b"])
                held = set()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], ["a", "b"])

    ordered = rows.select("key", "part", "doc", "n", "component", "sketch").repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are linked, compared on their whole texts."""
    needed = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    some = stored(texts.join(needed, "doc", "left_semi"), "neardup-texts")
    left = some.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = some.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known: dict[str, np.ndarray] = {}
            keep = []
            for x, y in zip(strings(batch.column("text_a")), strings(batch.column("text_b")), strict=True):
                for t in (x, y):
                    if t not in known:
                        if len(known) > 500:
                            known.clear()
                        known[t] = shingles(t)
                keep.append(linked(known[x] if x in known else shingles(x), known[y]))
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents are linked if their sets of 5-word shingles share 85 of 100 members of the union; links are confirmed
    on whole texts, and a component is named by the smallest doc_id in it. Rows with one doc_id are one
    document: it has the links of all its texts and the largest of their sets' sizes. Rows without doc_id are
    left as they are (no component, kept), texts without words are linked with nothing.

    1. Equal sets are classes, found by a digest; the smallest doc_id stands for each.
    2. 96 minhashes per class make 2 x 12 hashes of 4. A table's key is one hash of the first collection with one of the
       second: 144 tables of 8 minhashes. As a key can't be shared unless both its hashes are, hashes held by one class only
       are put aside before keys are formed; most texts then have no keys.
    3. Buckets with the same members count once. In each, in parts of CHUNK members dealt anew per table, a spanning
       forest of the likeliest links is proposed, at most one pair per member, and confirmed.
    4. What lies in one bucket but in two components after that is proposed in full (large buckets by pairs of
       blocks), but for pairs already compared. So every pair that shares a table is confirmed, refuted or joined through
       others. Pairs whose sizes or parity bits prove that they are no link are refuted on the spot, which
       leaves few to propose even in a large group of texts that are nearly linked.

    A pair at exactly 85 shares no table with probability 3e-4, one at 90 with 5e-6.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = stored(map_texts(rows, _sketch, SKETCH_SCHEMA), "neardup-sketches")
    some = sketched.where("n > 0 and doc_id is not null")
    classes = stored(
        some.groupBy("digest1", "digest2", "n").agg(F.min(F.struct("doc_id", "sketch", "halves")).alias("first"))
        .select("digest1", "digest2", "n", F.col("first.doc_id").alias("doc"), "first.sketch", "first.halves"),
        "neardup-classes")

    halves = classes.select("doc", F.posexplode("halves").alias("place", "half"))
    shared = stored(halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half"), "neardup-halves")
    mine = halves.join(shared, "half").groupBy("doc").agg(
        F.collect_list(F.when(F.col("place") < HALVES, F.col("half"))).alias("one"),
        F.collect_list(F.when(F.col("place") >= HALVES, F.col("half"))).alias("two"))
    keys = stored(
        mine.select("doc", F.explode("one").alias("h1"), "two").select("doc", "h1", F.explode("two").alias("h2"))
        .select("doc", F.xxhash64("h1", "h2").alias("key")), "neardup-keys")
    counted = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("s"), F.min("doc").alias("m")).where("c > 1")
    buckets = stored(counted.groupBy("c", "s", "m").agg(F.min("key").alias("key")).select("key", "c"), "neardup-buckets")
    members = stored(
        keys.join(buckets, "key").join(classes.select("doc", "n", "sketch"), "doc").select("key", "c", "doc", "n", "sketch"),
        "neardup-members")

    texts = rows.where("doc_id is not null").select(F.col("doc_id").alias("doc"), "text")
    block = F.pmod(F.xxhash64("doc", "key"), F.ceil(F.col("c") / CHUNK)).cast("long")
    tried = stored(
        _pairs(members.withColumns({"part": block, "component": F.lit(0).cast("long")}), _tree), "neardup-tried")
    # rows of one doc_id with different texts stand in several classes: that doc_id links them
    again = some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id")
    twice = some.join(again, "doc_id").join(classes.select("digest1", "digest2", "n", "doc"), ["digest1", "digest2", "n"])
    same_id = twice.groupBy("doc_id").agg(F.min("doc").alias("a"), F.collect_set("doc").alias("all")).select(
        "a", F.explode("all").alias("b")).where("a < b")
    sure = stored(_confirmed(tried, texts).union(same_id), "neardup-sure")

    near = components(sure)
    named = members.join(near.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc"))
    mixed = stored(
        named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"),
        "neardup-mixed")
    open_ = named.join(mixed, "key")
    blocks = F.ceil(F.col("c") / CHUNK).cast("long")
    spread = open_.withColumns({"block": block, "blocks": blocks}).withColumn("other", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.withColumn(
        "part", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    rest = _pairs(spread, _across).join(tried, ["a", "b"], "left_anti")
    more = stored(_confirmed(stored(rest, "neardup-rest"), texts), "neardup-more")
    links = sure if more.isEmpty() else stored(sure.union(more), "neardup-links")
    found = near if more.isEmpty() else components(links)

    # each document's class, then its component; a class without links is a component of its own
    of_class = classes.select("digest1", "digest2", "n", "doc").join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        "digest1", "digest2", "n", F.coalesce("component", "doc").alias("component"))
    placed = sketched.select("doc_id", "n", "digest1", "digest2").join(of_class, ["digest1", "digest2", "n"], "left")
    known = placed.where("doc_id is not null").groupBy("doc_id").agg(
        F.max("n").alias("n_shingles"), F.min("component").alias("component"))
    component = F.coalesce("component", "doc_id")
    out = known.select(
        "doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
    unnamed = sketched.where("doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.union(unnamed)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``link`` keeps, with all their columns; rows without doc_id stay.

    Where doc_ids repeat, every row is a document of its own, in order of doc_id and text: equal and linked rows leave one, and a
    text that is linked with nothing stays whatever else has its doc_id.
    """
    named = docs.where("doc_id is not null")
    if named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        gone = link(docs).where("not kept").select(F.col("doc_id").alias("__gone"))
        return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    place = "place"
    while place in {c.lower() for c in docs.columns}:
        place += "_"
    numbered = stored(global_rank(named, ["doc_id", "text"], place), "neardup-numbered")
    gone = link(numbered.select(F.col(place).alias("doc_id"), "text")).where("not kept").select(F.col("doc_id").alias("__gone"))
    left = numbered.join(gone, F.col(place) == F.col("__gone"), "left_anti").select(*docs.columns)
    return left.unionByName(docs.where("doc_id is null"))
