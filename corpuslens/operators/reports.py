"""Weekly and per-confidence reports, and the statements behind the best and worst buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.scores import confidence, confusion_flags, is_correct, ratio, rounded
from corpuslens.functions.text import word_count
from corpuslens.operators.evaluate import SHARES, with_confusion_flags
from corpuslens.plans.ranks import cut_into_tiles, global_rank, with_nested_span, with_span
from corpuslens.plans.slices import NONTWEET, TWEET, latest_reports, test_rows, week_start
from corpuslens.session import materialise

_SCORE = ("raw_pred", "label", "prediction")


def weekly_shares(rows: DataFrame) -> DataFrame:
    """Shares of tp, tn, fp, fn per week, weeks starting on Sunday."""
    flagged = with_confusion_flags(rows).withColumn("yweeks", week_start(F.col("sdate")))
    sums = flagged.groupBy("yweeks").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(s[:2]).alias(s[:2]) for s in SHARES]
    )
    return sums.select("yweeks", *[ratio(F.col(s[:2]), F.col("n")).alias(s) for s in SHARES])


def ground_truth_report(reports: DataFrame, stype: int | None = None) -> DataFrame:
    """Weekly shares of the latest model over its whole period."""
    return weekly_shares(latest_reports(reports, stype))


def test_matrix(reports: DataFrame, ds_metadata: DataFrame, stype: int | None = None) -> DataFrame:
    """Weekly shares inside the test dates."""
    return weekly_shares(test_rows(reports, ds_metadata, stype))


def confidence_matrix(
    reports: DataFrame, ds_metadata: DataFrame, stype: int | None = None, k: int = 25
) -> DataFrame:
    """Per confidence bucket: shares, mean word count, accuracy and its distance from confidence.

    Rows that tie on confidence are ordered by score, label, prediction and word count.
    """
    wc = word_count(F.col("statement_text")).alias("wc")
    hist = test_rows(reports, ds_metadata, stype).groupBy(*_SCORE, wc).agg(F.count(F.lit(1)).alias("n"))
    # at most 20,002 scores; each may occur with many word counts
    spans = with_nested_span(hist.withColumn("confidence", confidence()), ["confidence", *_SCORE], ["wc"])
    pieces = cut_into_tiles(spans, k)
    take = F.col("take")
    sums = pieces.groupBy(F.col("bucket").cast("int").alias("confidence_bucket")).agg(
        F.sum("take").alias("n"),
        F.sum(take * F.col("wc")).alias("words"),
        F.sum(take * F.col("confidence")).alias("conf"),
        F.sum(take * is_correct()).alias("right"),
        *[F.sum(take * c).alias(name) for name, c in confusion_flags().items()],
    )
    n = F.col("n")
    acc, conf = ratio(F.col("right"), n), ratio(F.col("conf"), n)
    return sums.select(
        "confidence_bucket",
        rounded(F.col("confidence_bucket") * F.lit(1.0) / k, 3).alias("max_conf_percentile"),
        rounded(ratio(F.col("words"), n), 0).alias("avg_wc"),
        *[rounded(ratio(F.col(s[:2]), n), 3).alias(s) for s in reversed(SHARES)],
        rounded(acc, 3).alias("acc"),
        rounded(conf, 3).alias("confidence"),
        rounded(acc - conf, 3).alias("acc_conf_delta"),
    )


def _extreme_groups(rows: DataFrame, k: int | Column, sides: tuple[str, ...]) -> DataFrame:
    """Score groups of each kind's first bucket with the extreme ppv, and which of their rows are in it."""
    hist = rows.groupBy("stype", *_SCORE).agg(F.count(F.lit(1)).alias("n")).withColumn("confidence", confidence())
    pieces = cut_into_tiles(with_span(hist, ["confidence", *_SCORE], ["stype"]), k)
    bucket = Window.partitionBy("stype", "bucket")
    kind = Window.partitionBy("stype")  # at most 20,002 score groups, some cut in two
    take = F.col("take")
    b = {name: F.sum(take * c).over(bucket) for name, c in confusion_flags().items()}
    size = F.sum(take).over(bucket)
    ppr = rounded(ratio(b["tp"] + b["fp"], size), 4)
    measured = pieces.withColumns(
        {
            "bucket_acc": rounded(ratio(F.sum(take * is_correct()).over(bucket), size), 4),
            "pos_pred_acc": F.coalesce(rounded(ratio(b["tp"], b["tp"] + b["fp"]), 4), F.lit(0.0)),
            "neg_pred_acc": F.coalesce(rounded(ratio(b["tn"], b["tn"] + b["fn"]), 4), F.lit(0.0)),
            "pos_pred_ratio": ppr,
            "neg_pred_ratio": rounded(1 - ppr, 4),
        }
    )
    keys = {"max": -F.col("pos_pred_acc"), "min": F.col("pos_pred_acc")}
    firsts = {side: F.min(F.struct(keys[side].alias("ppv"), "bucket")).over(kind)["bucket"] for side in sides}
    measured = measured.withColumns({f"first_{side}": first for side, first in firsts.items()})
    hits = [F.when(F.col("bucket") == F.col(f"first_{side}"), F.lit(side)) for side in sides]
    low = F.round((F.col("bucket") - 1) * 100.0 / k).cast("int").cast("string")
    high = F.round(F.col("bucket") * 100.0 / k).cast("int").cast("string")
    return measured.withColumn("side", F.explode(F.array_compact(F.array(*hits)))).select(
        "stype", *_SCORE, "side", "n", "take", "take_from",
        F.concat(low, F.lit("-"), high, F.lit("%")).alias("conf_percentile"),
        "bucket_acc", "pos_pred_acc", "neg_pred_acc", "pos_pred_ratio", "neg_pred_ratio",
    )


def _extreme_statements(rows: DataFrame, k: int | Column, sides: tuple[str, ...]) -> DataFrame:
    """Statements of the extreme buckets, tagged by ``stype`` and ``side``."""
    score, key = ["stype", *_SCORE], ["stype", *_SCORE, "side"]
    groups = materialise(_extreme_groups(rows, k, sides))
    edges = F.broadcast(groups.where(F.col("take") < F.col("n")).select(*key, "take_from", "take"))
    ranked = global_rank(rows.select(*score, "statement_id").join(edges, score), [*key, "statement_id"])
    starts = F.broadcast(ranked.groupBy(*key).agg(F.min("rn").alias("first_rn")))
    place = F.col("rn") - F.col("first_rn") + 1
    inside = (place > F.col("take_from")) & (place <= F.col("take_from") + F.col("take"))
    ids = ranked.join(starts, key).where(inside).groupBy(*key).agg(
        F.min("statement_id").alias("low"), F.max("statement_id").alias("high")
    )
    # at most 20,002 score groups per kind and side, two of them with an id range
    wanted = F.broadcast(groups.join(F.broadcast(ids), key, "left"))
    of_bucket = (F.col("take") == F.col("n")) | F.col("statement_id").between(F.col("low"), F.col("high"))
    found = rows.select(*score, "statement_id", "statement_text").join(wanted, score).where(of_bucket)
    return with_confusion_flags(found)


_STATEMENT = (
    "bucket_acc", "conf_percentile", "pos_pred_acc", "neg_pred_acc", "pos_pred_ratio", "neg_pred_ratio",
    "statement_id", "statement_text", "tp", "tn", "fp", "fn",
)


def extreme_ppv(
    reports: DataFrame, ds_metadata: DataFrame, stype: int, k: int, highest: bool = True
) -> DataFrame:
    """Statements of the lowest-numbered bucket with the highest (or lowest) positive predictive value.

    The bucket is found from score counts. Its rows then come by joining those score groups to the
    reports; for a group that a bucket edge runs through, at most two, statement ids are ranked to
    find the range of ids on this side of the edge.
    """
    rows = test_rows(reports, ds_metadata, stype)
    return _extreme_statements(rows, k, ("max" if highest else "min",)).select(*_STATEMENT)


def explained_statements(
    reports: DataFrame, ds_metadata: DataFrame, per_type: int = 100, seed: int = 2718
) -> DataFrame:
    """A seeded draw of statements from each of the four extreme buckets, tagged by bucket."""
    k = F.when(F.col("stype") == TWEET, 10).otherwise(25)
    rows = test_rows(reports, ds_metadata).where(F.col("stype").isin(TWEET, NONTWEET))
    found = _extreme_statements(rows, k, ("max", "min"))
    kind = F.when(F.col("stype") == TWEET, "tweets").otherwise("nontweets")
    tagged = found.withColumn("bucket_type", F.concat("side", F.lit("_ppv_"), kind))
    code = F.sha1(F.concat_ws("-", F.col("statement_id").cast("string"), F.lit(str(seed))))
    drawn = F.row_number().over(Window.partitionBy("bucket_type").orderBy(code, "statement_id"))
    first = tagged.withColumn("place", drawn).where(F.col("place") <= per_type)  # tasks pass on their first rows only
    return first.select("bucket_type", *_STATEMENT, "stype")
