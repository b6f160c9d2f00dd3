"""Word-count distributions of the two classes, before and after matching.

Everything is computed from counts per word count (and date), so a hot value is one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import word_count
from corpuslens.plans.ranks import with_span

PARTS = ("train", "val", "test")


def word_counts(populations: dict[str, DataFrame]) -> DataFrame:
    """(population, wc, n) for each named frame with a ``statement_text`` column."""
    wc = word_count(F.col("statement_text")).alias("wc")
    tagged = [df.select(F.lit(name).alias("population"), wc) for name, df in populations.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("population", "wc").agg(F.count(F.lit(1)).alias("n"))


def binned_density(counts: DataFrame, width: int = 5) -> DataFrame:
    """Share of each population per bin of word counts, divided by the bin width."""
    binned = counts.groupBy("population", (F.floor(F.col("wc") / width) * width).alias("bin")).agg(
        F.sum("n").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("population"))
    return binned.select("population", "bin", (F.col("n") / total / width).alias("density"))


def kernel_density(counts: DataFrame, grid: tuple[int, int, int] = (0, 120, 5)) -> DataFrame:
    """Gaussian kernel density of each population at grid points, bandwidth by Scott's rule."""
    n, wc = F.col("n").cast("double"), F.col("wc").cast("double")
    per_population = Window.partitionBy("population")
    total, mean = F.sum(n).over(per_population), F.sum(n * wc).over(per_population) / F.sum(n).over(per_population)
    centred = counts.withColumns({"total": total, "dev": wc - mean})
    var = F.sum(F.col("n") * F.col("dev") * F.col("dev")).over(per_population) / (F.col("total") - 1)
    scaled = centred.withColumn("h", F.sqrt(var) * F.pow("total", F.lit(-0.2)))
    points = scaled.withColumn("x", F.explode(F.sequence(*[F.lit(g) for g in grid])))
    z = (F.col("x") - F.col("wc")) / F.col("h")
    weight = F.exp(z * z * F.lit(-0.5)) * F.col("n") / (F.col("total") * F.col("h") * F.sqrt(2 * F.pi()))
    return points.groupBy("population", "x").agg(F.sum(weight).alias("density"))


def summary(counts: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles of ``wc``, from counts."""
    n, wc = F.col("n").cast("double"), F.col("wc").cast("double")
    size, s1, s2 = F.sum(n), F.sum(n * wc), F.sum(n * wc * wc)
    quartiles = F.percentile("wc", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    stats = counts.groupBy(*by).agg(
        F.sum("n").alias("count"),
        (s1 / size).alias("mean"),
        F.sqrt(F.try_divide(s2 - s1 * s1 / size, size - 1)).alias("std"),
        F.min("wc").alias("min"),
        quartiles.alias("q"),
        F.max("wc").alias("max"),
    )
    q = [F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return stats.select(*by, "count", "mean", "std", "min", *q, "max")


def _runs(rows: DataFrame, name: str) -> DataFrame:
    """Positions at which the word count of rows ordered by (s_date, wc) starts a run, and the end."""
    counted = rows.groupBy("s_date", "wc").agg(F.count(F.lit(1)).alias("n"))
    spans = with_span(counted, ["s_date", "wc"])
    starts = spans.select(F.col("lo").alias("pos"), F.struct(F.col("wc").alias("v")).alias(name))
    end = spans.agg(F.max("hi").alias("pos")).where(F.col("pos").isNotNull())
    return starts.unionByName(end.select("pos", F.struct(F.lit(None).cast("int").alias("v")).alias(name)))


def position_segments(truth_rows: DataFrame, falsehood_rows: DataFrame) -> DataFrame:
    """Both classes laid side by side by position: one row per stretch where neither value changes.

    The rows of each class are numbered by (s_date, wc). Runs of equal values are found from counts
    per day and word count, so no row is numbered one by one.
    """
    starts = _runs(truth_rows, "t").unionByName(_runs(falsehood_rows, "f"), allowMissingColumns=True)
    at = starts.groupBy("pos").agg(F.max("t").alias("t"), F.max("f").alias("f"))
    w = Window.orderBy("pos")  # at most days x word counts rows
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        at.select(
            F.col("pos").alias("lo"),
            F.lead("pos").over(w).alias("hi"),
            F.last("t", ignorenulls=True).over(running)["v"].alias("truths"),
            F.last("f", ignorenulls=True).over(running)["v"].alias("falsehoods"),
        )
        .where(F.col("hi").isNotNull())
    )


def positional_join(truth_rows: DataFrame, falsehood_rows: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Full outer join of the two word-count columns on row position (0-based)."""
    segments = position_segments(truth_rows, falsehood_rows)
    chunks = segments.withColumn("start", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(chunk)))).repartition("start")
    stop = F.least(F.col("start") + chunk, F.col("hi")) - 1
    return chunks.select(F.explode(F.sequence("start", stop)).alias("i"), "truths", "falsehoods")


def joint_density(truth_rows: DataFrame, falsehood_rows: DataFrame, width: int = 10) -> DataFrame:
    """Pairs of the positional join per cell of a two-dimensional grid."""
    pairs = position_segments(truth_rows, falsehood_rows).where("truths is not null and falsehoods is not null")
    cell = {
        "bin_x": F.floor(F.col("truths") / width) * width,
        "bin_y": F.floor(F.col("falsehoods") / width) * width,
    }
    return pairs.withColumns(cell).groupBy("bin_x", "bin_y").agg(F.sum(F.col("hi") - F.col("lo")).alias("n"))


def split_word_counts(truth_rows: DataFrame, falsehood_rows: DataFrame, split_dates: DataFrame) -> DataFrame:
    """(split, class, wc, n) for the date ranges of ``split_dates`` (one row of six dates)."""
    d = split_dates.select(F.struct("*")).scalar()
    wc = word_count(F.col("statement_text")).alias("wc")
    rows = truth_rows.select("s_date", wc, F.lit("truths").alias("class")).unionByName(
        falsehood_rows.select("s_date", wc, F.lit("falsehoods").alias("class"))
    )
    inside = [
        F.when(F.col("s_date").between(d[f"{p}_start_date"], d[f"{p}_end_date"]), F.lit(p)) for p in PARTS
    ]
    placed = rows.withColumn("split", F.explode(F.array_compact(F.array(*inside))))
    return placed.groupBy("split", "class", "wc").agg(F.count(F.lit(1)).alias("n"))


def class_gap(split_counts: DataFrame) -> DataFrame:
    """Per split, half the summed difference of the two classes' word-count shares (0 equal, 1 disjoint)."""
    sided = split_counts.groupBy("split", "wc").agg(
        *[F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0)).alias(c) for c in ("truths", "falsehoods")]
    )
    whole = Window.partitionBy("split")
    share = {c: F.try_divide(F.col(c), F.sum(c).over(whole)) for c in ("truths", "falsehoods")}
    gaps = sided.select("split", F.abs(share["truths"] - share["falsehoods"]).alias("d"))
    return gaps.groupBy("split").agg((F.sum("d") / 2).alias("gap"))


_MATRIX_NAMES = {
    "tp_ratio": "true positives",
    "tn_ratio": "true negatives",
    "fp_ratio": "false positives",
    "fn_ratio": "false negatives",
}


def weekly_frame(report: DataFrame) -> DataFrame:
    """A weekly report under the column names used in charts."""
    return report.withColumnsRenamed({"yweeks": "week", **_MATRIX_NAMES})


def confidence_frame(report: DataFrame) -> DataFrame:
    """A confidence report reduced to its shares, under the column names used in charts."""
    return report.select("confidence_bucket", *_MATRIX_NAMES).withColumnsRenamed(
        {"confidence_bucket": "confidence bucket", **_MATRIX_NAMES}
    )
