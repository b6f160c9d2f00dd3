"""Pairs of claim and truth vectors closer than a distance, exactly."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.plans.skew import lookup_join
from corpuslens.session import materialise


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def orthonormal(size: int, dims: int, seed: int) -> list[list[float]]:
    """``dims`` seeded directions of length one at right angles to each other."""
    rng, out = random.Random(seed), []
    while len(out) < min(size, dims):
        v = [rng.gauss(0, 1) for _ in range(size)]
        for _ in range(2):  # once more for what rounding left
            for d in out:
                along = sum(x * y for x, y in zip(v, d))
                v = [x - along * y for x, y in zip(v, d)]
        length = sum(x * x for x in v) ** 0.5
        if length > 1e-6:
            out.append([x / length for x in v])
    return out


def _projection(vector: Column, direction: list[float]) -> Column:
    weights = F.expr("array(" + ", ".join(f"{w!r}D" for w in direction) + ")")
    parts = F.zip_with(vector, weights, lambda x, w: x * w)
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def _distinct_vectors(df: DataFrame, vector: str, ident: str) -> DataFrame:
    """One row per distinct vector with its smallest id and number of copies."""
    return df.groupBy(F.col(vector).alias("v")).agg(F.min(ident).alias("id"), F.count(F.lit(1)).alias("copies"))


def representatives(df: DataFrame, ident: str = "id", vector: str = "vector") -> DataFrame:
    """Each id with the smallest id that has the same vector."""
    shared = _distinct_vectors(df, vector, ident).where(F.col("copies") > 1)
    firsts = shared.select(F.col("v").alias(vector), F.col("id").alias("representative"))
    found = lookup_join(df.select(ident, vector), firsts, [vector], [ident], "left")
    return found.select(ident, F.coalesce("representative", ident).alias("representative"))


FEW = 10_000  # split cells of a level that may be broadcast, a few hundred bytes each


def _split(cells: DataFrame, cuts: DataFrame, axis: int, slack: float) -> DataFrame:
    """Rows of ``cells`` (cell, id, p) in the children of their cells, in every child that ``slack`` around them reaches."""
    small = cuts.count() <= FEW
    met = cells.join(F.broadcast(cuts) if small else cuts, "cell")
    at = F.get("p", F.lit(axis))

    def child(edge: Column) -> Column:
        return F.size(F.filter("cuts", lambda c: c <= edge))

    reached = met.withColumn("child", F.explode(F.sequence(child(at - slack), child(at + slack))))
    return reached.select(F.concat_ws(".", "cell", "child").alias("cell"), "id", "p")


def partitioned(claims: DataFrame, truths: DataFrame, dims: int, slack: float, most: int, ways: int = 8) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows (id, p) as (cell, id, p), no cell with more than ``most`` truths where projections can part them.

    All start in one cell. Each round counts the truths of every open cell and cuts the fuller ones along the next axis at
    approximate quantiles of their own projections. A truth goes to one child, a claim to every child within
    ``slack`` of it, so a pair that close meets exactly once. Rounds end when no cell is too full; a cell that
    no axis can cut is kept whole. Only counts reach the driver; each round is written as a table.
    """
    columns = ["cell", "id", "p"]
    # not a plain literal, which would be folded into the joins and make them nested loops
    root = F.when(F.col("p").isNull(), F.lit("")).otherwise(F.lit("0"))
    open_truths, open_claims = (df.select(root.alias("cell"), "id", "p") for df in (truths, claims))
    closed_truths, closed_claims, stuck, level = [], [], 0, 0
    while True:
        at = F.get("p", F.lit(level % dims))
        quantiles = F.percentile_approx(at, [k / ways for k in range(1, ways)], F.lit(1000))
        sized = materialise(open_truths.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), quantiles.alias("cuts"), F.min(at).alias("lo"), F.max(at).alias("hi")))
        full = sized.where((F.col("n") > most) & (F.lit(stuck) < dims))
        # equal cuts part nothing from below; the cell stays whole this round
        cuts = full.select("cell", F.filter(F.array_distinct("cuts"), lambda c: c > F.col("lo")).alias("cuts"))
        light = sized.join(full.select("cell"), "cell", "left_anti").select("cell")
        closed_truths.append(open_truths.join(light, "cell", "left_semi").select(columns))
        closed_claims.append(open_claims.join(light, "cell", "left_semi").select(columns))
        if full.isEmpty():
            break
        parted = full.where("lo < hi").isEmpty()
        stuck = stuck + 1 if parted else 0
        open_truths = materialise(_split(open_truths, cuts, level % dims, 0.0))
        open_claims = materialise(_split(open_claims, cuts, level % dims, slack))
        level += 1
    return reduce(DataFrame.union, closed_truths), reduce(DataFrame.union, closed_claims)


def close_pairs(
    claims: DataFrame,
    truths: DataFrame,
    max_dist: float,
    size: int,
    dims: int = 16,
    ident: str = "id",
    vector: str = "vector",
    seed: int = 2718,
    most: int = 64,
) -> DataFrame:
    """(falsehood_id, truth_id, n_falsehoods, n_truths, l2dist) for all vector pairs closer than ``max_dist``.

    Copies of a vector are counted, not paired: each distinct vector stands for its copies under its
    smallest id (see ``representatives`` and ``with_copies``). Projections onto directions at right angles never lengthen a
    distance, so pairs within ``max_dist`` meet in a cell of ``partitioned``, and pairs whose projections alone are
    farther apart are refused before their vectors are compared. Cells hold at most ``most`` truths, so the candidates of a
    vector don't grow with the number of vectors, only with how many cells its ball reaches.
    """
    met = candidate_pairs(claims, truths, max_dist, size, dims, ident, vector, seed, most)
    found = met.withColumn("l2dist", l2_distance(F.col("fv"), F.col("tv")))
    return found.where(F.col("l2dist") < max_dist).select("falsehood_id", "truth_id", "n_falsehoods", "n_truths", "l2dist")


def candidate_pairs(claims: DataFrame, truths: DataFrame, max_dist: float, size: int, dims: int = 16, ident: str = "id",
                    vector: str = "vector", seed: int = 2718, most: int = 64) -> DataFrame:
    """The pairs of ``close_pairs`` whose vectors must be compared: falsehood_id, n_falsehoods, fv, truth_id, n_truths, tv."""
    directions = orthonormal(size, dims, seed)
    slack = max_dist * (1 + 1e-9) + 1e-12  # rounding of the projections

    def projected(df: DataFrame) -> DataFrame:
        rows = _distinct_vectors(df, vector, ident)
        return materialise(rows.withColumn("p", F.array(*[_projection(F.col("v"), d) for d in directions])))

    left, right = projected(claims), projected(truths)
    in_truths, in_claims = partitioned(left.select("id", "p"), right.select("id", "p"), len(directions), slack, most)
    a = in_claims.select("cell", F.col("id").alias("falsehood_id"), F.col("p").alias("fp"))
    b = in_truths.select("cell", F.col("id").alias("truth_id"), F.col("p").alias("tp"))
    gap = F.aggregate(F.zip_with("fp", "tp", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
    near = a.join(b, "cell").where(gap <= slack * slack).select("falsehood_id", "truth_id")
    claim = left.select(F.col("id").alias("falsehood_id"), F.col("copies").alias("n_falsehoods"), F.col("v").alias("fv"))
    truth = right.select(F.col("id").alias("truth_id"), F.col("copies").alias("n_truths"), F.col("v").alias("tv"))
    return near.join(claim, "falsehood_id").join(truth, "truth_id")


def with_copies(pairs: DataFrame, claims: DataFrame, truths: DataFrame) -> DataFrame:
    """``close_pairs`` for every id: (falsehood_id, truth_id, l2dist), each distinct vector's pair once per copy on either side.

    ``claims`` and ``truths`` are (id, representative) as ``representatives`` gives them.
    """
    a = claims.select(F.col("representative").alias("falsehood_id"), F.col("id").alias("claim"))
    b = truths.select(F.col("representative").alias("truth_id"), F.col("id").alias("truth"))
    met = pairs.select("falsehood_id", "truth_id", "l2dist").join(a, "falsehood_id").join(b, "truth_id")
    return met.select(F.col("claim").alias("falsehood_id"), F.col("truth").alias("truth_id"), "l2dist")
