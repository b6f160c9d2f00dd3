"""Benchmark decontamination: random-walk embeddings of item-sized windows, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import filter_texts, map_texts, strings
from corpuslens.llm.compression import word_codes

_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
WORDS = re.compile(rf"[{_UNSPACED}]|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F{_UNSPACED}]+")  # scripts without blanks: a character is a word
_CHARACTER = re.compile(f"[{_UNSPACED}]")
GRAM = 3
MIN_WORDS = 3  # shorter items take no edit; they are looked up as they stand
TABLE_BITS = 20
GROUP_WORDS = 1 << 19
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def item_codes(text: str) -> np.ndarray:
    """A hash of each of the text's WORDS."""
    return word_codes(text if text.isascii() else _CHARACTER.sub(r" \g<0> ", text))


def _grams(codes: np.ndarray, size: int = GRAM) -> np.ndarray:
    n = len(codes) - size + 1
    return _mixed(sum(codes[k:n + k] * _ODD[k] for k in range(size))) if n > 0 else np.zeros(0, np.uint64)


def edits_allowed(n: int, share: float) -> int:
    """Word edits that an item of ``n`` words may take: so few that one run of GRAM words stays whole, see ``Index``."""
    most = int(share * n)
    while most and math.ceil((n - most) / (most + 1)) < GRAM:
        most -= 1
    return most


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Edit distance of ``item`` to the stretch of ``region`` nearest to it: distance, start, stop."""

    def last_row(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        at = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else at.copy()
        for i, w in enumerate(a, 1):
            new = np.empty_like(row)
            new[0] = i
            np.minimum(row[:-1] + (b != w), row[1:] + 1, out=new[1:])
            row = np.minimum.accumulate(new - at) + at
        return row

    row = last_row(item, region, True)
    stop = int(row.argmin())
    back = last_row(item[::-1], region[:stop][::-1], False)
    return int(row[stop]), stop - int(back.argmin()), stop


@dataclass
class Walks:
    """Random walks for items of ``low`` to under ``2 * low`` words.

    At step j a walk reads the word under it and moves on if a random bit of (repetition, j, word) says so; two
    texts at small edit distance then read the same word at most steps. A key is the words read at ``picks`` steps
    drawn per repetition. Steps reach only as far as every item of the class does.
    """

    low: int
    bits: np.ndarray
    picks: np.ndarray

    @staticmethod
    def drawn(low: int, repetitions: int, sampled: int, seed: int) -> Walks:
        rng = np.random.default_rng([seed, low])
        steps = max(2, int(1.5 * low))
        bits = rng.integers(0, 1 << 63, (steps, repetitions), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        picks = np.zeros((steps, repetitions), bool)
        for r in range(repetitions):
            picks[rng.choice(steps, min(sampled, steps), replace=False), r] = True
        return Walks(low, bits, picks)

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys by (start, repetition). ``codes`` must run on for as many words as there are steps."""
        repetitions = self.bits.shape[1]
        at = np.repeat(starts[:, None], repetitions, axis=1)
        key = np.broadcast_to(np.arange(repetitions, dtype=np.uint64) * _ODD[1], at.shape).copy()
        last = int(np.flatnonzero(self.picks.any(axis=1))[-1])
        for j in range(last + 1):
            word = codes[at]
            pick = self.picks[j]
            if pick.any():
                key[:, pick] = _mixed(key[:, pick] * _ODD[0] + word[:, pick])
            at += ((word * self.bits[j]) >> np.uint64(63)).astype(at.dtype)
        return key


@dataclass
class Index:
    """A block of items: their words, the words' runs of GRAM, and per size class the walks with their keys.

    The edits allowed leave at least one run of GRAM words of an item whole, so a window that shares no run with any item at a
    fitting offset holds none within its distance; only the others are embedded. The walks then choose which items
    each window is compared with.
    """

    ids: list[int | None]
    codes: list[np.ndarray]
    share: float = 0.2
    repetitions: int = 24
    sampled: int = 3
    seed: int = 29
    allowed: np.ndarray = field(init=False)
    size: np.ndarray = field(init=False)

    def __post_init__(self):
        self.size = np.array([len(c) for c in self.codes], np.int64)
        self.allowed = np.array([edits_allowed(n, self.share) for n in self.size], np.int64)
        grams, owner, offset = [], [], []
        for i, c in enumerate(self.codes):
            g = _grams(c)
            grams.append(g)
            owner.append(np.full(len(g), i))
            offset.append(np.arange(len(g)))
        grams, owner, offset = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (grams, owner, offset))
        self.short = {}
        for n in range(1, MIN_WORDS):
            mine = np.flatnonzero(self.size == n)
            keys = np.concatenate([_grams(self.codes[i], n) for i in mine]) if len(mine) else np.zeros(0, np.uint64)
            order = np.argsort(keys, kind="stable")
            self.short[n] = keys[order], mine[order]
        order = np.argsort(grams, kind="stable")
        self.grams, self.owner, self.offset = grams[order].astype(np.uint64), owner[order], offset[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.grams >> np.uint64(64 - TABLE_BITS)] = True
        self.kind = np.array([int(math.log2(n / MIN_WORDS)) if n >= MIN_WORDS else -1 for n in self.size], np.int64)
        self.classes = {}
        for kind in np.unique(self.kind[self.kind >= 0]):
            walks = Walks.drawn(MIN_WORDS << int(kind), self.repetitions, self.sampled, self.seed)
            items = np.flatnonzero(self.kind == kind)
            keys, of = [], []
            for i in items:
                padded = np.r_[self.codes[i], np.zeros(len(walks.bits) + 1, np.uint64)]
                keys.append(walks.keys(padded, np.zeros(1, np.int64))[0])
                of.append(np.full(self.repetitions, i))
            keys, of = np.concatenate(keys), np.concatenate(of)
            order = np.argsort(keys, kind="stable")
            self.classes[int(kind)] = walks, keys[order], of[order]

    def matches(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, start, stop, distance) by words, one for each place of an item in a document."""
        for n, (keys, of) in self.short.items():
            for k, c in enumerate(docs if len(keys) else ()):
                found = _grams(c, n)
                lo, hi = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
                for at in np.flatnonzero(hi > lo):
                    for i in of[lo[at]:hi[at]]:
                        if np.array_equal(self.codes[i], c[at:at + n]):
                            yield k, int(i), int(at), int(at + n), 0
        pad = int(2 * self.size.max(initial=0)) + 8
        total = sum(len(c) for c in docs) + (len(docs) + 1) * pad
        codes, begin, stop = np.zeros(total, np.uint64), [], []
        at = pad
        for c in docs:
            codes[at:at + len(c)] = c
            begin.append(at)
            stop.append(at + len(c))
            at += len(c) + pad
        begin, stop = np.array(begin), np.array(stop)
        grams = _grams(codes)
        near = np.flatnonzero(self.table[grams >> np.uint64(64 - TABLE_BITS)])
        first = np.searchsorted(self.grams, grams[near], "left")
        count = np.searchsorted(self.grams, grams[near], "right") - first
        near, first, count = near[count > 0], first[count > 0], count[count > 0]
        if not len(near):
            return
        at = np.repeat(near, count)
        row = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        item, start = self.owner[row], at - self.offset[row]
        doc = np.searchsorted(begin, at, "right") - 1
        pairs = []
        for kind, (walks, keys, of) in self.classes.items():
            mine = self.kind[item] == kind
            if not mine.any():
                continue
            # windows from as many words before to as many after as the item may have gained or lost
            d = self.allowed[item[mine]]
            width = 2 * d + 1
            shift = np.arange(width.sum()) - np.repeat(np.r_[0, np.cumsum(width)[:-1]] + d, width)
            windows = np.repeat(start[mine], width) + shift
            owner = np.repeat(doc[mine], width)
            inside = (windows >= begin[owner]) & (windows < stop[owner])
            windows = np.unique(windows[inside])
            for part in np.array_split(windows, max(1, len(windows) // 4096)):
                if not len(part):
                    continue
                found = walks.keys(codes, part).ravel()
                lo, hi = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
                hit = np.flatnonzero(hi > lo)
                if len(hit):
                    n = hi[hit] - lo[hit]
                    into = np.repeat(lo[hit] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                    pairs.append(np.unique(np.c_[of[into], np.repeat(part[hit // self.repetitions], n)], axis=0))
        if not pairs:
            return
        pairs = np.unique(np.concatenate(pairs), axis=0)
        group = np.r_[True, (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 1] - pairs[:-1, 1] > self.allowed[pairs[1:, 0]] + 1)]
        for some in np.split(pairs, np.flatnonzero(group)[1:]):
            i, d = some[0, 0], self.allowed[some[0, 0]]
            k = int(np.searchsorted(begin, some[0, 1], "right") - 1)
            low = max(begin[k], some[0, 1] - d)
            high = min(stop[k], some[-1, 1] + self.size[i] + d)
            distance, a, b = best_match(self.codes[i], codes[low:high])
            if distance <= d:
                yield k, int(i), int(low - begin[k] + a), int(low - begin[k] + b), distance


def indexes(items: DataFrame, block_items: int = 20_000, share: float = 0.2) -> Iterator[Index]:
    """The items in blocks of about ``block_items``, each small enough to go to every task.

    Items without words are left out; equal ids or texts are items of their own.
    """
    known = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, math.ceil(known.count() / block_items))
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        codes = [(r["item_id"], item_codes(r["text"])) for r in rows]
        codes = [(k, c) for k, c in codes if len(c)]
        if codes:
            yield Index([k for k, _ in codes], [c for _, c in codes], share)


def _groups(texts: Iterator[str]) -> Iterator[tuple[list[int], list[str], list[np.ndarray]]]:
    """Documents in groups of some GROUP_WORDS words."""
    at, held, codes, words = [], [], [], 0
    for k, text in enumerate(texts):
        at.append(k)
        held.append(text)
        codes.append(item_codes(text))
        words += len(codes[-1])
        if words >= GROUP_WORDS:
            yield at, held, codes
            at, held, codes, words = [], [], [], 0
    if at:
        yield at, held, codes


def contaminated(docs: DataFrame, index: Index) -> DataFrame:
    """One row per place where a document holds an item of ``index``, within the word edits it allows.

    Returns doc_id, item_id, start, stop (code points, end exclusive), distance, item_words. Words are compared in
    lower case (A-Z) without marks. Whole texts are read; null and empty ones hold nothing. Repeated rows each give
    their rows; only doc_id and text are read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        ids = batch.column("doc_id")
        for at, texts, codes in _groups(strings(batch.column("text"))):
            spots: dict[int, list[re.Match]] = {}
            for k, i, start, stop, distance in index.matches(codes):
                words = spots.setdefault(k, list(WORDS.finditer(texts[k])))
                rows.append((ids[at[k]].as_py(), index.ids[i], words[start].start(), words[stop - 1].end(), distance,
                             int(index.size[i])))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        types = [pa.int64()] * 4 + [pa.int32()] * 2
        names = ["doc_id", "item_id", "start", "stop", "distance", "item_words"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = "doc_id long, item_id long, start long, stop long, distance int, item_words int"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def scan(docs: DataFrame, items: DataFrame, share: float = 0.2) -> DataFrame:
    """``contaminated`` for all items, one pass over the documents per block of items."""
    found = None
    for index in indexes(items, share=share):
        some = contaminated(docs, index)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return contaminated(docs, Index([], [])).where(F.lit(False))
    return found


def clean(docs: DataFrame, items: DataFrame, share: float = 0.2) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    for index in indexes(items, share=share):

        def accept(texts: pa.Array, index: Index = index) -> pa.Array:
            keep = np.ones(len(texts), bool)
            for at, _, codes in _groups(strings(texts)):
                for k, *_ in index.matches(codes):
                    keep[at[k]] = False
            return pa.array(keep)

        docs = filter_texts(docs, accept)
    return docs
