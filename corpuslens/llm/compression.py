"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import fold, labelled, map_texts, texts_of
from corpuslens.llm.subwords import hash_words

LEVEL = 6  # lower levels keep one dictionary position per hash slot, which blurs the comparison
CODE = 8

_FOLDED = np.full(256, 32, np.uint8)
for _b in range(256):
    _c = chr(_b)
    if _b >= 128 or "a" <= _c <= "z" or "0" <= _c <= "9":
        _FOLDED[_b] = _b
    elif "A" <= _c <= "Z":
        _FOLDED[_b] = _b + 32


def word_codes(text: str) -> np.ndarray:
    """Each word of the whole text, lower-cased without marks, as an 8-byte hash.

    A word then costs 8 incompressible bytes unless a dictionary holds it, whatever its length and letters.
    """
    return hash_words(text, _FOLDED)


@dataclass
class Model:
    """Two raw-content dictionaries of equal length and the weights that turn saved bytes into a score."""

    ordinary: bytes
    toxic: bytes
    window: int
    weights: np.ndarray

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self):
        out = []
        for content in (self.ordinary, self.toxic):
            held = None
            if content:
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def distances(self, codes: np.ndarray) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, by window of ``window`` words."""
        plain, toxic = self.compressors
        windows = [codes[i:i + self.window].tobytes() for i in range(0, len(codes), self.window)]
        return np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in windows], float)

    def inputs(self, codes: np.ndarray) -> np.ndarray:
        d = self.distances(codes)
        saved = np.maximum(d, 0).sum() if len(d) else 0.0
        return np.array([
            1.0, np.log1p(saved), np.log1p(100 * saved / max(20, len(codes))), d.max() > 0 if len(d) else 0.0,
            np.log1p(d.max()) if len(d) and d.max() > 0 else 0.0])

    def score(self, codes: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.inputs(codes) @ self.weights, -60, 60))))


def _frequent(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words by the number of documents that hold them, most first."""
    if not docs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words, counts = np.unique(np.concatenate([np.unique(d) for d in docs]), return_counts=True)
    order = np.argsort(-counts, kind="stable")
    return words[order], counts[order]


def dictionaries(ordinary: list[np.ndarray], toxic: list[np.ndarray], size: int, part: int,
                 support: float, ratio: float) -> tuple[bytes, bytes]:
    """Content of both dictionaries, the most frequent words last, where zstandard reaches them cheapest.

    Both open with the words that most ordinary documents hold; the toxic one closes with words that at
    least ``support`` of the toxic documents hold, ``ratio`` times their share of the ordinary ones, the
    ordinary one with as many words that occur nowhere, so equal words cost the same in both.
    """
    words, counts = _frequent(ordinary)
    base = words[:size // CODE]
    found, n = _frequent(toxic)
    at = np.searchsorted(words, found, sorter=np.argsort(words)) if len(words) else np.zeros(len(found), int)
    order = np.argsort(words)
    plain = np.zeros(len(found))
    if len(words):
        near = order[np.minimum(at, len(words) - 1)]
        plain = np.where(words[near] == found, counts[near], 0)
    keep = (n >= max(2, support * len(toxic))) & ~np.isin(found, base)
    keep &= n / max(1, len(toxic)) > ratio * (plain + 1) / max(1, len(ordinary))
    own = found[keep][:part // CODE]
    filler = np.random.default_rng(11).integers(1 << 63, size=len(own), dtype=np.uint64)
    return base[::-1].tobytes() + filler.tobytes(), base[::-1].tobytes() + own[::-1].tobytes()


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    pull = ridge * np.eye(x.shape[1])
    pull[0, 0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (p - y) + pull @ w)
    return w


def _coded(batch: pa.RecordBatch) -> pa.RecordBatch:
    codes = pa.array([word_codes(t).tobytes() for t in texts_of(batch)], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), codes], ["doc_id", "label", "codes"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", where=None, per_label: int = 4000,
          size: int = 131_072, part: int = 4096, support: float = 0.01, ratio: float = 10.0, window: int = 32) -> Model:
    """Fit on at most ``per_label`` documents of each label, the first by a hash of doc_id that ``where`` lets in.

    Two thirds of them give the dictionaries, the others calibrate: a logistic curve from saved bytes to the
    label. zstandard's own trainer picks stretches, not words, and missed nine of ten toxic words of the test rows, so the
    contents are ranked here by document counts. Without rows of both labels every score is the prior.
    """
    known = labels if where is None else labels.where(where)
    rows = None
    for value in (0, 1):
        some = labelled(docs, known, label, F.col("label") == value, per_label)
        rows = some if rows is None else rows.unionByName(some)
    pdf = map_texts(rows.select("doc_id", "label", "text"), _coded, "doc_id long, label int, codes binary").toPandas()
    pdf = pdf.sort_values(["doc_id", "codes"], kind="stable")
    codes = [np.frombuffer(c, np.uint64) for c in pdf["codes"]]
    y = pdf["label"].to_numpy() if len(pdf) else np.zeros(0, int)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", window, np.array([-4.0 if not len(y) or y.max() == 0 else 4.0, 0, 0, 0, 0]))
    for_test = np.zeros(len(y), bool)
    for value in (0, 1):
        for_test[np.flatnonzero(y == value)[::3]] = True
    own = [[c for c, t, v in zip(codes, for_test, y, strict=True) if not t and v == value] for value in (0, 1)]
    model = Model(*dictionaries(*own, size, part, support, ratio), window, np.zeros(5))
    x = np.array([model.inputs(c) for c, t in zip(codes, for_test, strict=True) if t])
    # rows are drawn by label; the prior of all labelled rows comes back through the intercept
    share = known.where(F.col(label).isNotNull()).agg(F.avg((F.col(label) == 1).cast("double"))).first()[0]
    drawn = float(y[for_test].mean())
    model.weights = _logistic(x, y[for_test])
    share = min(max(share, 1e-3), 1 - 1e-3)
    model.weights[0] += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return model


def classify(docs: DataFrame, model: Model, threshold: float = 0.7, parts: int = 3, rest: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts save nothing.

    Whole texts are read, window by window. Repeated rows score alike; only doc_id and text are read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = np.array([model.score(word_codes(t)) for t in texts_of(batch)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        F.col("doc_id").cast("long"), (fold(F.col("doc_id"), parts) == rest).alias("held_out"), "text")
    return map_texts(rows, run, "doc_id long, held_out boolean, score double, predicted int")
