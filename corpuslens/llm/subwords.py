"""Quality classifier: learned vectors of hashed words, word pairs and character n-grams, averaged, under a softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import fold, labelled, map_texts, texts_of

BITS = 16
GRAMS = (3, 4)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    code = (code + np.uint64(kind)) * _MIX
    return (((code ^ (code >> np.uint64(32))) * _P) >> np.uint64(64 - BITS)).astype(np.int32)


def _pieces(raw: bytes, blank: np.ndarray) -> list[bytes]:
    """The text in pieces that end before a byte of ``blank``, so that no word is cut and working arrays stay small.

    A piece has about ``CHUNK`` bytes, more where so many hold no blank.
    """
    out, at = [], 0
    while len(raw) - at > CHUNK:
        near = np.flatnonzero(blank[np.frombuffer(raw, np.uint8, CHUNK - 1, at + 1)])
        cut, ahead = at + 1 + int(near[-1]) if len(near) else 0, at + CHUNK
        while not cut and ahead < len(raw):
            some = np.flatnonzero(blank[np.frombuffer(raw, np.uint8, min(CHUNK, len(raw) - ahead), ahead)])
            cut, ahead = ahead + int(some[0]) if len(some) else 0, ahead + CHUNK
        if not cut:
            break
        out.append(raw[at:cut])
        at = cut
    return [*out, raw[at:]]


def hash_words(text: str, folded: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the whole text; ``folded`` maps bytes, those between words to a space."""
    out = []
    for piece in _pieces(text.encode("utf-8", "surrogatepass"), folded == 32):
        b = folded[np.frombuffer(b" " + piece + b" ", np.uint8)]
        space, x = b == 32, b.astype(np.uint64)
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, stop = edge[0::2], edge[1::2]
        total = np.r_[np.uint64(0), np.cumsum(x * _powers(_P, len(x)), dtype=np.uint64)]
        w = (total[stop] - total[start]) * _powers(_P_INVERSE, len(x))[start]
        w = (w ^ (w >> np.uint64(29))) * _MIX
        out.append(w ^ (w >> np.uint64(32)))
    return np.concatenate(out)


def _features(raw: bytes) -> np.ndarray:
    b = np.frombuffer(b" " + raw + b" ", np.uint8)
    space = _SPACE[b]
    x = np.where(space, 32, b).astype(np.uint64)
    out = []
    for n in GRAMS:  # a gram may begin or end with a space, which marks the edge of a word, but hold none inside
        if len(x) < n:
            continue
        code = x[:len(x) - n + 1].copy()
        inside = np.zeros(len(code), bool)
        for k in range(1, n):
            code = code * _P + x[k:len(x) - n + 1 + k]
            if k < n - 1:
                inside |= space[k:len(x) - n + 1 + k]
        out.append(_bucket(code[~inside], n))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, stop = edge[0::2], edge[1::2]  # the text is framed by spaces
    if len(start):
        total = np.r_[np.uint64(0), np.cumsum(x * _powers(_P, len(x)), dtype=np.uint64)]
        words = (total[stop] - total[start]) * _powers(_P_INVERSE, len(x))[start]
        out.append(_bucket(words, 1))
        out.append(_bucket(words[1:] - words[:-1], 2))  # word pairs; a word said twice is one feature for all words
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def features(text: str):
    """Buckets of all words, word pairs and character n-grams of one whole text, a piece at a time."""
    for piece in _pieces(text.encode("utf-8", "surrogatepass"), _SPACE):
        yield _features(piece)


@dataclass
class Model:
    """``lean`` is each bucket's vector times the difference of the two softmax rows: averaging vectors and
    applying the softmax is the same as averaging these numbers and applying the logistic function."""

    lean: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        total, n = 0.0, 0
        for found in features(text):
            total += float(self.lean[found].sum(dtype=np.float64))
            n += len(found)
        return float(1 / (1 + np.exp(-np.clip(total / max(1, n) + self.bias, -60, 60))))


def descend(buckets: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray,
            size: int = 16, epochs: int = 12, rate: float = 10.0, seed: int = 3) -> Model:
    """Stochastic gradient descent on vectors and softmax, one document a step, the rate falling to 0."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << BITS, size)).astype(np.float32)
    top, bias = np.zeros((2, size), np.float32), np.zeros(2, np.float32)
    steps, step = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            lr = rate * (1 - step / steps)
            step += 1
            at, share = buckets[i], shares[i]
            mean = share @ vectors[at]
            z = top @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ top
            top -= 0.05 * lr * np.outer(p, mean)
            bias -= 0.005 * lr * p
            vectors[at] -= (lr * share)[:, None] * back
    return Model((vectors @ (top[1] - top[0])).astype(np.float32), float(bias[1] - bias[0]))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    at, share = [], []
    for text in texts_of(batch):
        counts = np.zeros(1 << BITS, np.int64)
        for found in features(text):
            counts += np.bincount(found, minlength=1 << BITS)
        kept = np.flatnonzero(counts)
        at.append(kept.astype(np.uint16).tobytes())
        share.append((counts[kept] / max(1, counts.sum())).astype(np.float32).tobytes())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("label"), pa.array(at, pa.binary()), pa.array(share, pa.binary())],
        ["doc_id", "label", "at", "share"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", where=None, max_rows: int = 2000) -> Model:
    """Fit on at most ``max_rows`` labelled documents, the first by a hash of doc_id among those ``where`` lets in.

    Texts are hashed whole on the executors; only packed bucket counts come to the driver, 6 bytes a bucket.
    Without labels the model gives every text one half.
    """
    rows = labelled(docs, labels, label, where, max_rows).select("doc_id", "label", "text")
    known = map_texts(rows, _counted, "doc_id long, label int, at binary, share binary").toArrow()
    if not known.num_rows:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    at, share = known.column("at").to_pylist(), known.column("share").to_pylist()
    order = sorted(range(len(at)), key=lambda i, ids=known.column("doc_id").to_pylist(): (ids[i], at[i], share[i]))
    labels_of = known.column("label").to_numpy()
    return descend(
        [np.frombuffer(at[i], np.uint16) for i in order], [np.frombuffer(share[i], np.float32) for i in order],
        (labels_of[order] > 0).astype(int))


def classify(docs: DataFrame, model: Model, threshold: float, held_out=None, parts: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a null text reads as empty and scores the bias.

    Whole texts are hashed in pieces. Repeated rows score alike; only doc_id and text are read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = np.array([model.score(t) for t in texts_of(batch)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    held_out = (fold(F.col("doc_id"), parts) == rest) if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return map_texts(rows, run, "doc_id long, held_out boolean, score double, predicted int")
