"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import stored
from corpuslens.llm.spans import count_words

SPACE = r"[\x20\x09-\x0D]"
EDGE = 1e-9


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Targets in proportion to ``weights`` that add up to ``total``, none above ``most`` times its size.

    What a capped source can't take is shared again by weight; a source with the least room per weight
    is capped first, so one pass in that order ends where repeated resharing ends.
    """
    targets = [0.0] * len(sizes)
    order = sorted((i for i in range(len(sizes)) if weights[i] > 0), key=lambda i: most * sizes[i] / weights[i])
    left, weight = float(total), float(sum(weights[i] for i in order))
    for i in order:
        targets[i] = min(most * sizes[i], left * weights[i] / weight)
        left -= targets[i]
        weight -= weights[i]
    return targets


def _pair(size: np.ndarray, out: np.ndarray, rows: list[int], draws: np.ndarray) -> None:
    """Pivotal rounding of ``rows`` in order: of two open rows one becomes 0 or 1, the other goes on.

    Mass moves so that sum(size * part) stays; its way is drawn so that each expected value stays.
    """
    held = -1
    for i in rows:
        if out[i] <= EDGE or out[i] >= 1 - EDGE:
            out[i] = round(out[i])
            continue
        if held < 0:
            held = i
            continue
        p, q, a, b = out[held], out[i], size[held], size[i]
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
        move = up if draws[i] * (up + down) < down else -down
        p, q = p + move / a, q - move / b
        held_open, i_open = EDGE < p < 1 - EDGE, EDGE < q < 1 - EDGE
        out[held] = p if held_open else round(p)
        out[i] = q if i_open else round(q)
        held = held if held_open else i if i_open else -1


def settle(size: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round ``part`` (longest document first) so that sum(size * part) stays but for one open row.

    Rows that share one fraction, as all of a source do at first, are each paired with the pool of those
    after them: the row becomes 1 or 0 and the pool gives or takes its mass evenly, which leaves every
    expected value as it was. As the shortest come last, what stays open is short. Rows that the pool can't
    balance, and rows with unequal fractions, are paired one with another.
    """
    size, out = size.astype(float), part.astype(float).copy()
    draws, aside = rng.random(len(out)), list(range(len(out)))
    if len(out) and EDGE < out[0] < 1 - EDGE and np.all(out == out[0]):
        pool, q, aside = float(size.sum()), float(out[0]), []
        for i, a in enumerate(size):
            out[i] = q
            if q <= EDGE or q >= 1 - EDGE:
                out[i] = round(q)
            elif a >= pool * min(q, 1 - q):
                aside.append(i)
            elif draws[i] < q:
                out[i], q = 1.0, (q * pool - a) / (pool - a)
            else:
                out[i], q = 0.0, q * pool / (pool - a)
            pool -= a
        draws = rng.random(len(out))
    _pair(size, out, aside, draws)
    return out


def _level(seed: int, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "order", "doc_id"], ascending=[False, True, True], kind="stable")
        pieces = []
        for rank, piece in pdf.groupby("rank", sort=True):
            rng = np.random.default_rng([seed, level, int(rank), int(piece["bucket"].iloc[0])])
            pieces.append(piece.assign(part=settle(piece["size"].to_numpy(), piece["part"].to_numpy(), rng)))
        return pd.concat(pieces) if pieces else pdf

    return run


def mix(
    docs: DataFrame,
    weight_of: Callable[[list[str | None]], dict[str | None, float]],
    total_share: float = 1.0,
    most: float = 3.0,
    seed: int = 17,
    rows_per_bucket: int = 2000,
    fan_in: int = 64,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Copies of every document so that each source's words come near its target.

    A document of a source with target t and size s gets t / s copies: the whole part at once, the
    fraction by pivotal rounding. Documents are dealt into buckets by a hash, so a hot source is in all of
    them; a bucket settles all but one document of each source, and these are merged ``fan_in`` at a time up a
    tree until one per source is left, which is drawn by its probability. So a source misses its target by less than
    one document, the last being a short one as long documents settle first.

    ``weight_of`` gets all sources in code point order (null last). Sources are a configured list: their
    totals, one row per source, go through the driver. A null or empty text has size 0 and takes nothing; a
    null id or source is a value like any other; a repeated row counts as a document of its own.
    Only doc_id, text and source are read, so other columns can't clash; ``carry`` names columns to pass through (a row's
    number, say, to find its text by). Draws depend on hashes and the seed
    alone: reruns and lost tasks give the same rows.

    Returns doc_id, size, source, source_size, target, copies, taken and the carried columns.
    """
    spark = docs.sparkSession
    size = count_words(F.coalesce("text", F.lit("")), SPACE)
    sized = stored(docs.select("doc_id", "source", size.alias("size"), *carry), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names = [r["source"] for r in totals]
    weights = weight_of(names)
    sizes = [r["size"] for r in totals]
    targets = water_fill(sizes, [weights.get(n, 0.0) for n in names], total_share * sum(sizes), most)
    rows = sum(r["rows"] for r in totals)
    buckets = max(1, math.ceil(rows / rows_per_bucket))

    plan = spark.createDataFrame(
        [(n, k, s, t, t / s if s else 0.0) for k, (n, s, t) in enumerate(zip(names, sizes, targets, strict=True))],
        "source string, rank int, source_size long, target double, share double").withColumnRenamed("source", "__source")
    wanted = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # a whole number of copies must not turn into one less by the last bit of a division
    share = F.when(F.abs(F.col("share") - F.round("share")) < EDGE, F.round("share")).otherwise(F.col("share"))
    order = F.xxhash64(F.lit(seed), "doc_id", "source", "size")
    wanted = wanted.withColumns({
        "base": F.when(F.col("size") > 0, F.floor(share)).otherwise(0).cast("bigint"),
        "part": F.when(F.col("size") > 0, share - F.floor(share)).otherwise(0.0),
        "order": order,
        "bucket": F.pmod(order, F.lit(buckets)).cast("bigint"),
    })
    columns = ["doc_id", "size", "rank", "base", "part", "order", "bucket", *carry]
    schema = wanted.select(columns).schema
    done, level, keys = [], 0, ["bucket"]
    rest = wanted.select(columns)
    is_open = (F.col("part") > EDGE) & (F.col("part") < 1 - EDGE)
    while True:
        out = stored(rest.groupBy(*keys).applyInPandas(_level(seed, level), schema), f"mix-level{level}")
        done.append(out.where(~is_open))
        rest = out.where(is_open)
        if buckets == 1:
            break
        buckets = math.ceil(buckets / fan_in)
        rest = rest.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("bigint"))
        level, keys = level + 1, ["rank", "bucket"]
    # the last open row of a source: drawn by its own probability
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), "rank", "order"), F.lit(1 << 30)) / float(1 << 30)
    done.append(rest.withColumn("part", F.when(draw < F.col("part"), 1.0).otherwise(0.0)))
    settled = done[0]
    for piece in done[1:]:
        settled = settled.unionByName(piece)
    copies = F.col("base") + F.round("part").cast("bigint")
    return settled.join(F.broadcast(plan), "rank").select(
        "doc_id", "size", F.col("__source").alias("source"), "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"), *carry)
