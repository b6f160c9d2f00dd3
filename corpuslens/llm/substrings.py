"""Substring dedup: hashed lines, sentences or runs of words, the earliest occurrence kept."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import map_texts, stored, texts_of

# units cover the text without gaps, so their lengths give the offsets
LINES = r"[^\n]+\n*|\n+"
SENTENCES = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"
PARAGRAPHS = r"(?:[^\n]|\n(?!\n))+\n*|\n+"

UNIT_SCHEMA = "doc_id long, row long, unit int, start long, stop long, words int, digest1 long, digest2 long"
_LAST = (1 << 63) - 1

SPAN, REACH = 20, 11  # words of an anchor; of so many anchors in a row the one with the smallest digest is taken
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ANCHOR_SCHEMA = "doc_id long, row long, pos int, digest1 long, digest2 long"
CONTEXT_SCHEMA = "doc_id long, row long, pos int, before array<long>, after array<long>, starts array<long>, stops array<long>"
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def units(docs: DataFrame, pattern: str = SENTENCES) -> DataFrame:
    """One row per unit with a word: its place, code point offsets, words and 128-bit digest.

    A unit is normalised before hashing: A-Z lower-cased, words joined by one space.
    """
    cut = re.compile(pattern)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs_out, rows_out = batch.column("doc_id"), batch.column("row")
        at, unit, start, stop, words, digests = [], [], [], [], [], []
        for k, text in enumerate(texts_of(batch)):
            n = 0
            for m in cut.finditer(text):
                tokens = m.group().encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
                if tokens:
                    at.append(k)
                    unit.append(n)
                    start.append(m.start())
                    stop.append(m.end())
                    words.append(len(tokens))
                    digests.append(xxhash.xxh3_128_digest(b" ".join(tokens)))
                    n += 1
        halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
        index = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [docs_out.take(index), rows_out.take(index), pa.array(unit, pa.int32()), pa.array(start, pa.int64()),
             pa.array(stop, pa.int64()), pa.array(words, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
            ["doc_id", "row", "unit", "start", "stop", "words", "digest1", "digest2"])

    rows = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text")
    return map_texts(rows, run, UNIT_SCHEMA)


def repeats(docs: DataFrame, pattern: str = SENTENCES, min_words: int = 20) -> DataFrame:
    """Passages to remove: runs of neighbouring units that all occurred earlier, of ``min_words`` words in total.

    Occurrences are ranked by doc_id (null last) and offset; rows that repeat a doc_id come one after the other. The
    earliest of each digest is kept wherever it is. A unit of its own of ``min_words`` words is a run too, so with
    ``LINES`` and a small ``min_words`` this is plain line dedup; sentences also find passages pasted into a line, and
    the sum over the run leaves short stock phrases in place. Null and empty texts have no units.

    Digests are counted with partial aggregation; only those met twice are written out and joined back to
    the units, by a plain equi-join whose hot keys AQE can split. One row per passage: doc_id, row, start, stop (code
    points of the original text, end exclusive), words, units, and first_doc_id, first_start of the kept copy of its first unit.
    """
    found = stored(units(docs, pattern), "units")
    rank = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "row", "start", "doc_id")
    keys = ["digest1", "digest2"]
    counted = found.groupBy(*keys).agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stored(counted.select(*keys, "first"), "unit-firsts")
    later = found.join(firsts, keys).where(
        (F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    by_unit = Window.partitionBy("row").orderBy("unit")
    runs = later.withColumn("run", F.col("unit") - F.row_number().over(by_unit))
    return runs.groupBy("row", "run").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("stop").alias("stop"),
        F.sum("words").alias("words"), F.count(F.lit(1)).alias("units"), F.min(F.struct("start", "first")).alias("at"),
    ).where(F.col("words") >= min_words).select(
        "doc_id", "row", "start", "stop", "words", "units",
        F.col("at.first.doc_id").alias("first_doc_id"), F.col("at.first.start").alias("first_start"))


def _hashes(text: str) -> np.ndarray:
    """The words' hashes, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _rolled(words: np.ndarray, at: np.ndarray | slice, base: np.uint64) -> np.ndarray:
    """Digests of the SPAN words from each place in ``at``."""
    n = len(words) - SPAN + 1
    out = np.zeros(n if isinstance(at, slice) else len(at), np.uint64)
    for k in range(SPAN):
        out = out * base + words[k:k + n][at]
    return out


def chosen(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and digests of the anchors: texts that share SPAN + REACH - 1 words in a row share one inside them."""
    if len(words) < SPAN + REACH - 1:
        return np.empty(0, np.int64), np.empty((0, 2), np.int64)
    digests = _rolled(words, slice(None), _BASES[0])
    least = np.lib.stride_tricks.sliding_window_view(digests, REACH).argmin(axis=1)
    at = np.unique(least + np.arange(len(least)))
    return at, np.stack([digests[at], _rolled(words, at, _BASES[1])], axis=1).view(np.int64)


def _anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [chosen(_hashes(text)) for text in texts_of(batch)]
    index = pa.array(np.repeat(np.arange(len(found)), [len(at) for at, _ in found]))
    digests = np.concatenate([d for _, d in found])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(index), batch.column("row").take(index),
         pa.array(np.concatenate([at for at, _ in found]).astype(np.int32)), pa.array(digests[:, 0]), pa.array(digests[:, 1])],
        ["doc_id", "row", "pos", "digest1", "digest2"])


def _contexts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Words beside each asked anchor, nearest first, and the offsets at which a span ends that takes 0, 1, ... of them."""
    out = []
    asked = zip(batch.column("doc_id"), batch.column("row"), batch.column("asked"), texts_of(batch), strict=True)
    for doc_id, row, places, text in asked:
        words = _hashes(text).view(np.int64)
        at = np.array([m.span() for m in WORD.finditer(text)])
        for pos in places.as_py():
            low, stop = max(0, pos - REACH), pos + SPAN
            out.append({
                "doc_id": doc_id.as_py(), "row": row.as_py(), "pos": pos, "before": words[low:pos][::-1],
                "after": words[stop:stop + REACH], "starts": at[low:pos + 1, 0][::-1], "stops": at[stop - 1:stop + REACH, 1]})
    many = pa.list_(pa.int64())
    return pa.RecordBatch.from_pylist(out, pa.schema([
        ("doc_id", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()), ("before", many), ("after", many),
        ("starts", many), ("stops", many)]))


def _shared(mine: Column, other: Column) -> Column:
    """How many words two arrays share from their start on."""
    same = F.zip_with(mine, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(same, False)  # from 1 on, 0 if none does
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1)


def passages(docs: DataFrame, min_words: int = 30) -> DataFrame:
    """Passages to remove wherever they begin and end: runs of ``min_words`` or more words that all occurred earlier.

    Words are cut at blanks and compared with A-Z lower-cased. Anchors of SPAN words are picked by the smallest digest of
    REACH neighbours, so equal words give equal anchors whatever stands around them. The first occurrence of
    an anchor, by doc_id (null last), row and place, stays; runs of later ones that touch are joined and extended word by word,
    at either end against the kept copy of the anchor there, before the limit is applied. Copies in one text don't overlap.

    Every repeat of SPAN + 3 * REACH - 3 = 50 words or more is found, less at most REACH - 1 words at an end whose
    anchor was kept from yet another text; one of SPAN + REACH - 1 = 30 to 49 words is, unless the kept copy of its anchors
    stands in another text that shares less of it. Shorter ones, null and empty texts give nothing.

    Anchors are counted with partial aggregation and joined back by equi-joins whose hot keys AQE can split; the texts of
    a run and of its kept copies are read once more for the words beside it. One row per passage: doc_id, row, start,
    stop (code points of the original text, end exclusive), words, and first_doc_id, first_start of the kept copy of its first words.
    """
    texts = stored(docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text"), "texts")
    found = stored(map_texts(texts, _anchors, ANCHOR_SCHEMA), "anchors")
    keys = ["digest1", "digest2"]
    rank = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "row", "pos")
    firsts = found.groupBy(*keys).agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stored(firsts.select(*keys, F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")), "anchor-firsts")
    later = found.join(firsts, keys).where((F.col("row") != F.col("first_row")) | (F.col("pos") >= F.col("first_pos") + SPAN))
    by_pos = Window.partitionBy("row").orderBy("pos")
    new = F.coalesce(F.col("pos") > F.lag("pos").over(by_pos) + SPAN, F.lit(True)).cast("int")
    ends = F.struct("pos", "first_row", "first_pos")
    runs = later.withColumn("new", new).withColumn("run", F.sum("new").over(by_pos)).groupBy("row", "run").agg(
        F.min(ends).alias("head"), F.max(ends).alias("tail"))
    runs = stored(runs, "runs")

    asked = F.explode(F.array(*[F.struct(F.col(r).alias("row"), F.col(p).alias("pos")) for r, p in (
        ("row", "head.pos"), ("row", "tail.pos"), ("head.first_row", "head.first_pos"), ("tail.first_row", "tail.first_pos"))]))
    places = runs.select(asked.alias("at")).select("at.row", "at.pos").distinct()
    places = places.groupBy("row").agg(F.collect_list("pos").alias("asked"))  # distinct places of one text
    beside = stored(map_texts(texts.join(places, "row"), _contexts, CONTEXT_SCHEMA), "contexts")

    def end(name: str, row: str, pos: str, columns: list[str]) -> DataFrame:
        return beside.select(F.col("row").alias(row), F.col("pos").alias(pos), F.struct(*columns).alias(name))

    flat = runs.select("row", F.col("head.pos").alias("pos1"), F.col("head.first_row").alias("row1"), F.col("head.first_pos").alias("from1"),
                       F.col("tail.pos").alias("pos2"), F.col("tail.first_row").alias("row2"), F.col("tail.first_pos").alias("from2"))
    joined = (flat.join(end("head", "row", "pos1", ["doc_id", "before", "starts"]), ["row", "pos1"])
              .join(end("tail", "row", "pos2", ["after", "stops"]), ["row", "pos2"])
              .join(end("head1", "row1", "from1", ["doc_id", "before", "starts"]), ["row1", "from1"])
              .join(end("tail1", "row2", "from2", ["after"]), ["row2", "from2"]))
    room = F.when(F.col("row") == F.col("row1"), F.col("pos1") - F.col("from1") - SPAN)
    grown = joined.withColumns({
        "left": F.least(_shared(F.col("head.before"), F.col("head1.before")), room).cast("int"),
        "right": _shared(F.col("tail.after"), F.col("tail1.after")).cast("int")})
    return grown.withColumn("words", (F.col("pos2") - F.col("pos1") + SPAN + F.col("left") + F.col("right")).cast("long")).where(
        F.col("words") >= min_words).select(
        F.col("head.doc_id").alias("doc_id"), "row", F.get("head.starts", F.col("left")).alias("start"),
        F.get("tail.stops", F.col("right")).alias("stop"), "words",
        F.col("head1.doc_id").alias("first_doc_id"), F.get("head1.starts", F.col("left")).alias("first_start"))
