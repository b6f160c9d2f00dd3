"""Phrase collocations: n-grams counted inside the distinct chunks of a prefix-free parse, behind filters of hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import stored
from corpuslens.plans.skew import lookup_join

LONGEST = 4  # words of the longest phrase
WINDOW = LONGEST - 1  # words that two chunks share: a phrase that begins inside a chunk never outgrows it
SLAB = 4 << 20  # bytes of text worked on at once
BLOCK = 1 << 18  # bytes whose words are hashed at once
MAX_BITS = 1 << 26
BUCKETS = 1 << 12  # of hashes, each summed up at once
_BASE = 0xA3B195354A39B70D  # of the word hashes, odd, so that it has an inverse

_END = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(
    10 if b in _END else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


@lru_cache
def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _word_codes(b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the words b[start:stop], the same for equal words wherever they stand.

    The bytes are the digits of a number modulo 2^64, read off running sums; a word longer than ``BLOCK`` is hashed by itself.
    """
    out = np.empty(len(start), np.uint64)
    up, down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    at = 0
    while at < len(start):
        low = start[at]
        to = int(np.searchsorted(stop, low + BLOCK, "right"))
        if to <= at:
            to = at + 1
            out[at] = xxhash.xxh3_64_intdigest(b[low:stop[at]].tobytes())
        else:
            size = stop[to - 1] - low
            total = np.zeros(size + 1, np.uint64)
            np.cumsum((b[low:low + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
            out[at:to] = (total[stop[at:to] - low] - total[start[at:to] - low]) * down[start[at:to] - low]
        at = to
    return _mixed(out)


def _lang_codes(langs: pa.Array) -> np.ndarray:
    """A 64-bit hash of each language, worked out once per distinct one."""
    coded = langs.dictionary_encode()
    each = np.fromiter((xxhash.xxh3_64_intdigest(w, 1) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return each[coded.indices.to_numpy()] if len(each) else np.zeros(0, np.uint64)


def _windows(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last places, too near the end, read past their text."""
    out = word.copy()
    for k in range(1, n):
        out[:len(word) - k] = _mixed(out[:len(word) - k] * _B + word[k:])
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of each range, one after another."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) - np.repeat(before - start, size)


def _slabs(batches: Iterator[pa.RecordBatch], column: str, slab: int = SLAB) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``slab`` bytes of ``column`` (a longer text is a batch of its own)."""
    held, room = [], slab
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            n = int(np.searchsorted(np.cumsum(sizes[at:], dtype=np.int64), room, "right"))
            n = n if n or held else 1
            if n:
                held.append(batch.slice(at, n))
                room -= int(sizes[at:at + n].sum())
                at += n
            if at < len(sizes):
                yield _one(held)
                held, room = [], slab
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, piece of each, text of each, hash of each) of folded texts; pieces end at line ends, so none spans two texts."""
    b = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    gap = (b == 32) | (b == 10)
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, stop = edge[0::2], edge[1::2]
    ends = np.flatnonzero(b == 10)
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(b[~gap]))])
    return words, np.searchsorted(ends, start), np.searchsorted(begins, start, "right") - 1, _word_codes(b, start, stop)


def _chunks(batch: pa.RecordBatch, every: int) -> pa.RecordBatch | None:
    """The parse of a slab of texts: its distinct chunks with their frequency."""
    texts = [(t.as_py() or "").encode("utf-8", "surrogatepass").translate(_FOLD) for t in batch.column("text")]
    words, piece, text, code = _words(texts)
    n = len(piece)
    first = np.ones(n, bool)
    first[1:] = piece[1:] != piece[:-1]
    opens = first.copy()
    if n >= WINDOW:
        whole = piece[WINDOW - 1:] == piece[:n - WINDOW + 1]
        opens[:n - WINDOW + 1] |= whole & (_windows(code, WINDOW)[:n - WINDOW + 1] % np.uint64(every) == 0)
    start = np.flatnonzero(opens)
    stop = np.append(start[1:], n)
    last = np.append(first[start[1:]], True)[:len(start)]
    size = stop - start + np.where(last, 0, WINDOW)
    lists = pa.LargeListArray.from_arrays(
        np.concatenate([[0], np.cumsum(size)]).astype(np.int64), words.take(pa.array(_ranges(start, size))))
    found = pa.table({
        "lang": batch.column("lang").take(pa.array(text[start])), "last": pa.array(last), "words": pa.array(stop - start),
        "chunk": pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.string())})
    found = found.group_by(["lang", "last", "chunk"]).aggregate([([], "count_all"), ("words", "sum")])
    return _one(found.select(["lang", "last", "chunk", "count_all", "words_sum"]).to_batches()) if found.num_rows else None


def dictionary(docs: DataFrame, every: int = 16) -> DataFrame:
    """(lang, last, chunk, n, words): the distinct chunks of a prefix-free parse of all texts with their parse frequency.

    Texts are cut at sentence marks and line ends into pieces; a piece is cut wherever the hash of the next ``WINDOW`` words is 0
    modulo ``every``, so equal passages are cut alike wherever they stand. Such a chunk reaches to the end of the
    window that opens the next one, the last of a piece (``last``) to the piece's end. Copies cost one row each way. All words of the texts are in the sum of ``words``,
    which leaves out those that the next chunk repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, "text"):
            found = _chunks(slab, every)
            if found is not None:
                yield found

    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    parsed = rows.mapInArrow(run, "lang string, last boolean, chunk string, n long, words long")
    return parsed.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))


class Filter:
    """A Bloom filter of phrases, at most ``MAX_BITS`` bits: more phrases let more through, and none is refused wrongly."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, np.uint64(64 - int(len(bits) * 64).bit_length() + 1)

    @staticmethod
    def places(code: np.ndarray, shift: np.uint64) -> list[np.ndarray]:
        return [_mixed(code * _A) >> shift, _mixed(code * _B) >> shift]

    def passes(self, code: np.ndarray) -> np.ndarray:
        out = np.ones(len(code), bool)
        for at in self.places(code, self.shift):
            out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out

    @classmethod
    def of(cls, codes: DataFrame, bits_each: int = 12) -> Filter:
        """Set on the executors; the driver gets one row per 64 bits of the filter, so at most ``MAX_BITS`` bits."""
        size = 1024
        wanted = bits_each * codes.count()
        while size < min(wanted, MAX_BITS):
            size *= 2
        shift = np.uint64(64 - size.bit_length() + 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    at = np.concatenate(cls.places(batch.column("code").to_numpy().view(np.uint64), shift))
                    slots, index = np.unique(at >> np.uint64(6), return_inverse=True)
                    mask = np.zeros(len(slots), np.uint64)
                    np.bitwise_or.at(mask, index, np.uint64(1) << (at & np.uint64(63)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots.astype(np.int64)), pa.array(mask.view(np.int64))], ["slot", "mask"])

        set_bits = codes.select("code").mapInArrow(run, "slot long, mask long")
        found = set_bits.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        bits = np.zeros(size // 64, np.uint64)
        bits[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
        return cls(bits)


Known = dict[int, Filter]  # by length, what the hashes of the frequent phrases pass


class _Slab:
    """The words of a slab of chunks, one after another: their bytes, chunks and hashes."""

    def __init__(self, batch: pa.RecordBatch):
        chunks = batch.column("chunk").cast(pa.large_binary())
        _, offsets, data = chunks.buffers()
        edges = np.frombuffer(offsets, np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        self.bytes = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]]
        edges = edges - edges[0]
        opens = np.zeros(len(self.bytes) + 1, bool)
        self.blank = self.bytes == 32
        opens[1:] = self.blank
        opens[edges] = True
        starts = np.flatnonzero(opens)
        self.start, self.stop = starts[:-1], starts[1:] - self.blank[starts[1:] - 1]
        self.first = np.searchsorted(self.start, edges)
        self.size = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.last = batch.column("last").to_numpy(zero_copy_only=False)
        self.times = batch.column("n").to_numpy()
        self.langs = batch.column("lang")

    def own(self, n: int) -> np.ndarray:
        """Where phrases of ``n`` words start; one inside the words that the next chunk repeats is counted there."""
        return _ranges(self.first[:-1], np.maximum(self.size - np.where(self.last, n - 1, WINDOW), 0))

    def codes(self, upto: int) -> Iterator[np.ndarray]:
        """For 1, 2, ... words the hash of the language and the phrase from each word on; its last bits tell the length."""
        word = _word_codes(self.bytes, self.start, self.stop)
        code = word + _lang_codes(self.langs)[self.row]
        for n in range(1, upto + 1):
            if n > 1:
                code[:len(word) - n + 1] = _mixed(code[:len(word) - n + 1] * _B + word[n - 1:])
            yield (code & ~np.uint64(LONGEST - 1)) | np.uint64(n - 1)

    def numbers(self) -> tuple[np.ndarray, pa.Array]:
        """(number of each word, the words by number), exact inside the slab."""
        offsets = np.concatenate([[0], np.cumsum(self.stop - self.start)]).astype(np.int64)
        coded = pa.Array.from_buffers(
            pa.large_binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(self.bytes[~self.blank])]).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _summed(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(code):
        return code, times
    order = np.argsort(code)
    code = code[order]
    edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[edge], np.add.reduceat(times[order], edge)


def _hashes(batch: pa.RecordBatch, lengths: Sequence[int], known: Known) -> pa.RecordBatch | None:
    """Hashes of the phrases of a slab of chunks with their frequency, those whose parts ``known`` can't rule out: a row a bucket."""
    slab, found, passed = _Slab(batch), [], {}
    for n, code in enumerate(slab.codes(max(lengths)), 1):
        if n in known:
            passed[n] = known[n].passes(code)
        if n in lengths:
            start = slab.own(n)
            for part, maybe in passed.items():
                for k in range(n - part + 1):
                    start = start[maybe[start + k]]
            found.append((code[start], slab.times[slab.row[start]]))
    code, times = _summed(np.concatenate([c for c, _ in found]), np.concatenate([t for _, t in found]))
    if not len(code):
        return None
    bucket, edge = np.unique((code // np.uint64((1 << 64) // BUCKETS)).astype(np.int32), return_index=True)
    offsets = pa.py_buffer(np.append(edge, len(code)).astype(np.int32) * np.int32(8))
    packed = [pa.Array.from_buffers(pa.binary(), len(bucket), [None, offsets, pa.py_buffer(x)]) for x in (code, times.astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array(bucket), *packed], ["bucket", "codes", "times"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, frequencies) of each bucket from rows sorted by bucket."""
    held: list[pa.RecordBatch] = []

    def whole() -> tuple[np.ndarray, np.ndarray]:
        code, times = (b"".join(v.as_buffer() for b in held for v in b.column(name)) for name in ("codes", "times"))
        return _summed(np.frombuffer(code, np.uint64), np.frombuffer(times, np.int64))

    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        edge = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for at, to in zip(edge[:-1], edge[1:], strict=True):
            if held and at < to and held[0].column("bucket")[0].as_py() != bucket[at]:
                yield whole()
                held = []
            if at < to:
                held.append(batch.slice(at, to - at))
    if held:
        yield whole()


def frequent_codes(chunks: DataFrame, lengths: Sequence[int], known: Known, least: int) -> DataFrame:
    """(code): hashes of the phrases of these lengths that stand in ``least`` places or more, by the parse frequency of their chunks.

    Phrases with a part that ``known`` refuses are left out. Phrases that share a hash are counted as one, so none is missed.
    Hashes travel by the bucket, sorted, since there are almost as many as words; a bucket has one in ``BUCKETS`` of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, "chunk"):
            found = _hashes(slab, lengths, known) if slab.num_rows else None
            if found is not None:
                yield found

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, times in _buckets(batches):
            yield pa.RecordBatch.from_arrays([pa.array(code[times >= least].view(np.int64))], ["code"])

    rows = chunks.select("lang", "last", "chunk", "n").mapInArrow(run, "bucket int, codes binary, times binary")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(total, "code long")


def frequent_hashes(chunks: DataFrame, least: int) -> Known:
    """Filters, one a length, that the hashes of all phrases in ``least`` places or more pass.

    All parts of a frequent phrase are frequent too, so phrases of three and four words are counted only where both or all three
    pairs in them passed.
    """
    known: Known = {}
    for lengths in ((1, 2), (3, 4)):
        codes = stored(frequent_codes(chunks, lengths, known, least), "codes")
        known |= {n: Filter.of(codes.where(F.col("code").bitwiseAND(LONGEST - 1) == n - 1)) for n in lengths}
    return known


def _grams(batch: pa.RecordBatch, lengths: Sequence[int], known: Known) -> Iterator[pa.RecordBatch]:
    """Phrases of a slab of chunks with their frequency, those that ``known`` can't rule out."""
    slab = _Slab(batch)
    word, names = slab.numbers()
    langs = slab.langs.dictionary_encode()
    number = langs.indices.to_numpy().astype(np.int64)[slab.row]
    maybe = np.ones(len(word), bool)  # where the phrase of one word less passed
    codes = slab.codes(max(lengths)) if known else None
    for n in range(1, max(lengths) + 1):
        code = next(codes) if known else None
        start = slab.own(n)
        start = start[maybe[start]]
        if n in known:
            start = start[known[n].passes(code[start])]
        if not len(start):
            return
        # phrases get numbers that are exact inside the slab
        coded = pa.array(number[start] * len(names) + word[start + n - 1]).dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        number[start] = index
        maybe[:] = False
        maybe[start] = True
        if n in lengths:
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, index, slab.times[slab.row[start]])
            example = np.zeros(len(total), np.int64)
            example[index] = start
            parts = [names.take(pa.array(word[example + k])) for k in range(n)]
            phrase = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
            yield pa.RecordBatch.from_arrays(
                [slab.langs.take(pa.array(slab.row[example])), phrase.cast(pa.string()), pa.array(total)], ["lang", "phrase", "f"])


def counts(chunks: DataFrame, words: int | Sequence[int], known: Known | None = None) -> DataFrame:
    """(lang, phrase, f): phrases of ``words`` words inside distinct chunks, weighted by parse frequency.

    Those whose hashes ``known`` refuses, or whose first words', are left out.
    """
    lengths = [words] if isinstance(words, int) else list(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, "chunk"):
            if slab.num_rows:
                yield from _grams(slab, lengths, known or {})

    rows = chunks.select("lang", "last", "chunk", "n").mapInArrow(run, "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _part(first: int, words: int):
    return F.array_join(F.slice(F.split("phrase", " "), first, words), " ")


def _scored(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): the lowest-scoring cut of each phrase, ties to the earliest."""
    cuts = stored(phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "k",
        F.array_join(F.slice(F.split("phrase", " "), F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(F.split("phrase", " "), F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right")), "cuts")
    found = cuts
    # one word may open or close a large share of a language's phrases
    for side, f in (("left", "l"), ("right", "r")):
        part = frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
        found = lookup_join(found, part, ["lang", side], ["phrase", "k"], count_on=cuts)
    score = F.expr("cast(2000000 as decimal(18,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("best")
    return found.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def _inside(longer: DataFrame) -> DataFrame:
    """(lang, phrase, whole): each phrase of two words or more inside a longer candidate, with the largest f of those."""
    places = [(first, n, words) for words in range(3, LONGEST + 1) for n in range(2, words) for first in range(1, words - n + 2)]
    parts = F.array(*[F.when(F.col("words") == words, _part(first, n)) for first, n, words in places])
    inner = longer.select("lang", F.explode(F.array_compact(parts)).alias("phrase"), "f")
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("whole"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, every: int = 16, salts: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to four words.

    A-Z are lower-cased, pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A null text is empty, a null lang is
    ``und``; repeated rows count as often as they stand. A phrase that occurs ``least`` times or more is a candidate; its score is
    floor(2000000 a / (l + r)) for the cut that scores lowest, and it goes if a longer candidate, scored well or
    not, holds it in at least four of five places. Fewer than ``top`` rows come back for a language that has fewer.
    Without documents there are no rows.

    Only the parse reads the texts. Phrases are counted in its dictionary, first by hash, the long ones where all pairs in them are
    frequent, then those that may be frequent as they stand; arithmetic is in DECIMAL(38). Every number is a sum, so any order of
    tasks gives the same.
    """
    chunks = stored(dictionary(docs, every), "chunks")
    words = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    known = frequent_hashes(chunks, least)
    found = counts(chunks, range(1, LONGEST + 1), known).where(F.col("f") >= least)
    frequent = stored(found.withColumn("words", F.size(F.split("phrase", " "))), "phrases")
    phrases = frequent.where("words > 1")
    dropped = F.coalesce(100 * F.col("whole").cast("decimal(20,0)") >= 80 * F.col("a").cast("decimal(20,0)"), F.lit(False))
    left = _scored(phrases, frequent).join(_inside(phrases.where("words > 2")), ["lang", "phrase"], "left").where(~dropped)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)  # one language may hold most phrases
    near = (left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("near", F.row_number().over(salted))
            .where(F.col("near") <= top))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "score")
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
