"""Quality rules: rule statistics of each text, judged by an isolation forest."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import filter_texts, known_labels, map_texts, stored, texts_of
from corpuslens.plans.ranks import global_rank, running_totals

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
TREES, SUBSET = 200, 32
FEATURES = ("word_length", "symbol_share", "upper_share", "mark_share", "distinct_share")

# byte classes: 0 other, 1 lower, 2 upper, 3 ASCII mark
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a"):ord("z") + 1], _CLASS[ord("A"):ord("Z") + 1] = 1, 2
for _c in r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~""":
    _CLASS[ord(_c)] = 3


def repeat_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more in the text, first occurrence included."""
    n = len(ids)
    if n < 4:
        return 0
    base = int(ids.max()) + 1
    pairs = ids[:-1] * base + ids[1:]
    if base > 1_000_000:  # keep the product below 2**63
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * base + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    at = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
    hit = twice[at] == windows
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The five counts and the features of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dups = len(lines) - len(set(lines))
    repeats = repeat_words(ids)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=4)
    return [n, chars, symbols, dups, repeats], [
        chars / max(1, n), symbols / max(1, n), kinds[2] / max(1, kinds[1] + kinds[2]), kinds[3] / max(1, chars),
        len(seen) / max(1.0, n ** 0.75)]


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


@dataclass
class Forest:
    """Random splits stored as full binary trees; ``depth`` holds the path length of the leaf below each last node."""

    feature: np.ndarray
    cut: np.ndarray
    depth: np.ndarray
    levels: int
    norm: float
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected length): near 1 for rows that few splits isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, depth in zip(self.feature, self.cut, self.depth, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.levels):
                at = 2 * at + 1 + (x[rows, feature[at]] >= cut[at])
            total += depth[at - (2 ** self.levels - 1)]
        return 2.0 ** (-total / (len(self.feature) * self.norm))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, rows: int = SUBSET, seed: int = 5, subsets: list[np.ndarray] | None = None) -> Forest:
    """An isolation forest: each tree splits a random subset at random cuts of random features.

    Small subsets keep junk of one kind from hiding itself by its number. ``subsets`` gives the rows of ``x`` that each tree
    takes; by default they are drawn from all of ``x``.
    """
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    levels = max(1, math.ceil(math.log2(max(2, rows))))
    nodes, leaves = 2 ** levels - 1, 2 ** levels
    feature = np.zeros((trees, nodes), np.int64)
    cut = np.full((trees, nodes), -np.inf)
    depth = np.zeros((trees, leaves))
    for t in range(trees):
        stack = [(0, 0, x[rng.choice(len(x), rows, replace=False) if subsets is None else subsets[t]])]
        while stack:
            node, level, part = stack.pop()
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
            can = np.flatnonzero(high > low)
            if level == levels or len(part) <= 1 or not len(can):
                left, width = (node + 1) * 2 ** (levels - level) - 1 - nodes, 2 ** (levels - level)
                depth[t, left:left + width] = level + _expected(len(part))  # all leaves below: cuts of -inf go right
                continue
            f = int(rng.choice(can))
            at = rng.uniform(low[f], high[f])
            feature[t, node], cut[t, node] = f, at
            right = part[:, f] >= at
            stack += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return Forest(feature, cut, depth, levels, max(_expected(rows), 1e-9))


def calibrate(scored: DataFrame, false_reject: float = 0.005) -> float:
    """The cut with the best share of bad rows above less good rows above, among those that reject at most
    ``false_reject`` of the good rows. Without rows of both labels nothing is rejected.

    ``scored`` (score, good) may have any number of rows; they are counted per score and summed up inside ranges.
    """
    good = F.col("good")
    hist = scored.groupBy("score").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    falling = running_totals(hist.withColumn("down", -F.col("score")), ["down"], ["good", "bad"])
    upto = stored(falling.select("score", *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("good", "bad")]), "rule-scores")
    n_good, n_bad = upto.agg(F.max("good"), F.max("bad")).first()
    if not n_good or not n_bad:
        return 1.0
    lost, caught = F.col("good") / F.lit(n_good), F.col("bad") / F.lit(n_bad)
    best = upto.where(lost <= false_reject).orderBy((caught - lost).desc(), F.desc("score")).select("score").first()
    if best is None:
        return 1.0
    below = upto.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return best["score"] if below is None else (best["score"] + below) / 2


def _stats_schema(ids: str) -> str:
    return f"{ids}, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"


def _stats(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts, features = zip(*(statistics(t) for t in texts_of(batch)), strict=True)
    kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
    names = [name for name in batch.schema.names if name != "text"]
    columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
    return pa.RecordBatch.from_arrays([*kept, *columns, pa.array(features, pa.list_(pa.float64()))], [*names, *COUNTS, "features"])


def _grown(rows: DataFrame, n: int, seed: int = 5) -> Forest:
    """The forest over ``n`` stored rows, of which only those that its trees take come to the driver.

    Each tree draws its subset from all rows by their rank, so at most ``TREES * SUBSET`` features are fetched; where there are no
    more rows than that, all come and the trees draw from them.
    """
    order = ["doc_id", *COUNTS, "features"]
    if n <= TREES * SUBSET:
        return grow(np.array(rows.orderBy(*order).select("features").toPandas()["features"].tolist()), seed=seed)
    rng = np.random.default_rng([seed, 1])
    drawn = [rng.choice(n, SUBSET, replace=False) for _ in range(TREES)]
    wanted = np.unique(np.concatenate(drawn))
    ranks = F.broadcast(rows.sparkSession.createDataFrame([(int(r) + 1,) for r in wanted], "rn bigint"))
    found = global_rank(rows.select(*order), order).join(ranks, "rn").select("rn", "features").toPandas().sort_values("rn")
    x = np.array(found["features"].tolist())
    return grow(x, seed=seed, subsets=[np.searchsorted(wanted, d) for d in drawn])


def fit(docs: DataFrame, labels: DataFrame, where=None, false_reject: float = 0.005) -> Forest:
    """Grow the forest on the rule statistics of all labelled documents that pass the base rules and calibrate its
    threshold on all their quality labels.

    Statistics are taken before labels are joined, so texts are neither shuffled nor sent to the driver.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    stats = map_texts(texts, _stats, _stats_schema("doc_id long, digest string"))
    passed = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    own = passed.join(known_labels(labels, "quality", where), "doc_id").dropDuplicates(["doc_id", "digest"])
    rows = stored(own.select("doc_id", *COUNTS, "features", (F.col("label") == 1).alias("good")), "rule-statistics")
    n = rows.count()
    if n < 2:
        return Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 1, 1.0)
    forest = _grown(rows, n)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = forest.score(np.array(batch.column("features").to_pylist()))
        return pa.RecordBatch.from_arrays([pa.array(scores), batch.column("good")], ["score", "good"])

    forest.threshold = calibrate(map_texts(rows.select("features", "good"), score, "score double, good boolean"), false_reject)
    return forest


def _verdict(stats: pa.RecordBatch, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = base_failed(stats.column("n_words").to_numpy(), stats.column("n_repeat_words").to_numpy())
    x = np.array(stats.column("features").to_pylist())
    score = forest.score(x) if len(forest.feature) else np.zeros(len(x))
    return failed, ~failed & (score < forest.threshold), score


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """Statistics and verdict of every document, one row per input row.

    A null text counts as empty; texts are read whole. ``kept`` is false if a base rule fails (under 50 words,
    more than half of the words in repeated 3-word windows), else whether the anomaly score is below the
    calibrated threshold. Repeated rows are judged alike; other columns of ``docs`` are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = _stats(batch)
        failed, kept, score = _verdict(stats, forest)
        return pa.RecordBatch.from_arrays(
            [*(stats.column(c) for c in ["doc_id", *COUNTS]), pa.array(failed), pa.array(kept), pa.array(score)],
            ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def accepted(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""

    def accept(texts: pa.Array) -> pa.Array:
        return pa.array(_verdict(_stats(pa.RecordBatch.from_arrays([texts], ["text"])), forest)[1])

    return filter_texts(docs, accept)
