"""Exact ranks without sending all rows through one task.

Three forms, by what is known about the order key:

* few distinct values (word counts, dates, DECIMAL(5,4) scores): one aggregation to a
  histogram, then a running total over the histogram rows only;
* rows that tie on the key but agree on everything that is later summed are
  interchangeable, so ``ntile`` buckets can be cut out of a histogram by counting;
* any key: range partitioning, position inside the partition, plus partition offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.session import materialise

_POSITION_BITS = 33  # monotonically_increasing_id keeps the position in its low 33 bits


def with_span(hist: DataFrame, order: Sequence[str], within: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Add ``lo``, ``hi`` and ``total``: histogram row covers ranks ``lo + 1 .. hi`` of ``total``."""
    ordered = Window.partitionBy(*within).orderBy(*order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumns(
        {
            "hi": F.sum(n).over(running),
            "total": F.sum(n).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    ).withColumn("lo", F.col("hi") - F.col(n))


def with_nested_span(hist: DataFrame, coarse: Sequence[str], fine: Sequence[str], n: str = "n") -> DataFrame:
    """``with_span`` by (coarse, fine) for a large histogram whose coarse part alone is small.

    Only one row per coarse key is summed up in one task and broadcast; the rest runs per coarse key.
    Coarse keys are never NULL; saying so gives both uses of the histogram one plan, computed once.
    """
    hist = reduce(lambda df, c: df.where(F.col(c).isNotNull()), coarse, hist)
    sums = hist.groupBy(*coarse).agg(F.sum(n).alias("n"))
    starts = with_span(sums, coarse).select(*coarse, F.col("lo").alias("__start"), "total")
    inner = Window.partitionBy(*coarse).orderBy(*fine).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hist.join(F.broadcast(starts), list(coarse)).withColumn("hi", F.col("__start") + F.sum(n).over(inner))
    return placed.withColumn("lo", F.col("hi") - F.col(n)).drop("__start")


def cume_dist(df: DataFrame, value: str, within: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value with its count ``n`` and cumulative share ``c_dist``."""
    hist = df.groupBy(*within, value).agg(F.count(F.lit(1)).alias("n"))
    spans = with_span(hist, [value], within)
    return spans.select(*within, value, "n", (F.col("hi") / F.col("total")).alias("c_dist"))


def _div(a: Column, b: Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, b)


def tile_of_rank(rank: Column, k: Column, total: Column) -> Column:
    """The ``ntile`` bucket of a 1-based rank; the first ``total % k`` buckets get one row more."""
    per, rest = _div(total, k), total % k
    long_rows = rest * (per + 1)
    in_long = _div(rank - 1, per + 1) + 1
    in_short = rest + _div(rank - 1 - long_rows, F.greatest(per, F.lit(1))) + 1
    return F.when(rank <= long_rows, in_long).otherwise(in_short)


def cut_into_tiles(spans: DataFrame, k: int | Column) -> DataFrame:
    """Split histogram spans at bucket edges: one row per (span, bucket) with ``take`` rows in it."""
    sized = spans.withColumn("__k", F.lit(k) if isinstance(k, int) else k)
    k, total = F.col("__k"), F.col("total")
    first, last = tile_of_rank(F.col("lo") + 1, k, total), tile_of_rank(F.col("hi"), k, total)
    pieces = sized.withColumns(
        {"__per": _div(total, k), "__rest": total % k, "bucket": F.explode(F.sequence(first, last))}
    )

    def last_rank(tile: Column) -> Column:
        return tile * F.col("__per") + F.least(tile, F.col("__rest"))

    upto = F.least(F.col("hi"), last_rank(F.col("bucket")))
    after = F.greatest(F.col("lo"), last_rank(F.col("bucket") - 1))
    return pieces.withColumns({"take_from": after - F.col("lo"), "take": upto - after}).drop("__k", "__per", "__rest")


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rn") -> DataFrame:
    """1-based rank of every row over the whole frame, for any number of rows.

    ``order`` should end in a unique column, so that no value can fill a range partition
    on its own. The ranged rows are written to the checkpoint folder because they are read
    twice: once to count each partition, once to add the offsets.
    """
    part, pos = "__part", "__pos"
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(pos, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(pos, _POSITION_BITS))
        .withColumn(pos, F.col(pos) - F.shiftleft(part, _POSITION_BITS))
    )
    placed = materialise(placed)
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    offsets = with_span(sizes, [part]).select(part, F.col("lo").alias("__offset"))
    ranked = placed.join(F.broadcast(offsets), part)  # one row per partition
    return ranked.withColumn(out, F.col("__offset") + F.col(pos) + 1).drop(part, pos, "__offset")


def running_totals(hist: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Adds ``{s}_before`` for each of ``sums``: its total over all rows that come earlier in ``order``, for any number of rows.

    ``order`` must be unique, as the keys of a histogram are. Rows are summed inside sampled ranges; only one row per
    range is summed up in one task and broadcast.
    """
    part = "__part"
    placed = materialise(hist.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    parts = placed.groupBy(part).agg(*[F.sum(s).alias(s) for s in sums])
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(part, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"__{s}") for s in sums])
    inner = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = placed.join(F.broadcast(starts), part)
    return found.withColumns(
        {f"{s}_before": F.col(f"__{s}") + F.coalesce(F.sum(s).over(inner), F.lit(0)) for s in sums}
    ).drop(part, *[f"__{s}" for s in sums])


def _few_values(kind: T.DataType) -> bool:
    """Whether a type has so few values that one task may go through all of them."""
    return isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType)) or (isinstance(kind, T.DecimalType) and kind.precision <= 5)


def smallest_per_group(
    df: DataFrame, group: Sequence[str], quota: str, code: str, unique: str, bin_chars: int = 3
) -> DataFrame:
    """Rows with the ``quota`` smallest ``code`` values of each group.

    ``code`` is an evenly spread hex string (a hash). Counting by its first characters finds,
    per group, the bin the quota ends in; higher bins are dropped and the rest is numbered bin
    by bin, so the largest piece sorted at once is about 1/4096th of a group.
    """
    binned = df.withColumn("__bin", F.substring(code, 1, bin_chars))
    counts = binned.groupBy(*group, "__bin").agg(F.count(F.lit(1)).alias("n"), F.max(quota).alias("__quota"))
    reach = (
        with_span(counts, ["__bin"], group)
        .where(F.col("lo") < F.col("__quota"))
        .select(*group, "__bin", (F.col("__quota") - F.col("lo")).alias("__left"))
    )
    in_bin = Window.partitionBy(*group, "__bin").orderBy(code, unique)
    kept = binned.join(reach, [*group, "__bin"]).withColumn("__rn", F.row_number().over(in_bin))
    return kept.where(F.col("__rn") <= F.col("__left")).drop("__bin", "__left", "__rn")


def auc(df: DataFrame, score: str, label: str, out: str = "est_auc") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half; NULL for an empty class.

    Rows are counted per score. Scores of a narrow type are then summed up in one task, others (doubles, wide
    decimals, of which every row may have its own) over range partitions.
    """
    hist = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    if _few_values(df.schema[score].dataType):
        upto = F.sum("n").over(Window.orderBy(score).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    else:
        hist, upto = running_totals(hist, [score], ["n"]), F.col("n_before") + F.col("n")
    won = F.col("p").cast("double") * (upto.cast("double") - F.col("n") / 2)
    ranked = hist.select("p", "n", won.alias("won"))
    pairs = F.sum("p").cast("double") * F.sum("n").cast("double")
    return ranked.agg(F.try_divide(F.sum("won"), pairs).alias(out))
