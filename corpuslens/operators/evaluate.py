"""Classifier evaluation: confusion ratios, MCC, exact AUC, calibration by confidence bucket.

The bucket operators make one pass over the reports. Scores are DECIMAL(5,4), so counting
rows per (score, label, prediction) leaves at most 40,004 rows per statement kind however
many reports there are; AUC, accuracy, MCC and ``ntile`` buckets all follow from those
counts. Ties on confidence are ordered by score, label and prediction; rows that still tie
agree on every number that is summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.scores import confidence, confusion_flags, flag, is_correct, mcc, ratio, rounded
from corpuslens.plans.ranks import auc, cut_into_tiles, with_span
from corpuslens.plans.slices import GROUND_TRUTH, NONTWEET, TWEET, latest_version, newest_dataset, test_rows

KINDS = {"all": None, "tweet": TWEET, "nontweet": NONTWEET}
BUCKETS = {"all": 25, "nontweet": 25, "tweet": 10}
SHARES = ("tp_ratio", "tn_ratio", "fp_ratio", "fn_ratio")
GLOBALS = ("acc", "auc", "mcc", *SHARES)


def with_confusion_flags(df: DataFrame) -> DataFrame:
    """Add tp, fp, tn, fn."""
    return df.withColumns(confusion_flags())


def current_mcc(reports: DataFrame, ds_metadata: DataFrame, stype: int | None = None) -> DataFrame:
    """MCC and the four shares over the test dates; one row."""
    rows = with_confusion_flags(test_rows(reports, ds_metadata, stype))
    sums = rows.agg(*[F.sum(c).alias(c) for c in ("tp", "tn", "fp", "fn")])
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    n = tp + fp + tn + fn
    shares = [ratio(F.col(s[:2]), n).alias(s) for s in SHARES]
    return sums.select(mcc(tp, tn, fp, fn).alias("mcc"), *shares)


def current_auc(reports: DataFrame, ds_metadata: DataFrame, stype: int | None = None) -> DataFrame:
    """Exact AUC over the test dates; one row."""
    return auc(test_rows(reports, ds_metadata, stype), "raw_pred", "label")


def bucket_table(reports: DataFrame, ds_metadata: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts per (kind, confidence bucket) with the kind's totals beside them, in one scan."""
    stype = KINDS[kinds[0]] if len(kinds) == 1 else None
    rows = test_rows(reports, ds_metadata, stype)
    score = ("raw_pred", "label", "prediction")
    if len(kinds) == 1:
        hist = rows.groupBy(*score).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kinds[0]))
    else:
        counts = rows.groupBy("stype", *score).agg(F.count(F.lit(1)).alias("n"))
        own = F.when(F.col("stype") == TWEET, "tweet").when(F.col("stype") == NONTWEET, "nontweet")
        tagged = counts.withColumn("kind", F.explode(F.array(F.lit("all"), own)))
        hist = tagged.where(F.col("kind").isin(*kinds)).groupBy("kind", *score).agg(F.sum("n").alias("n"))

    negatives = F.when(F.col("label") == 0, F.col("n")).otherwise(0)
    by_score = Window.partitionBy("kind").orderBy("raw_pred")
    below_or_tied = F.sum(negatives).over(by_score.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    tied = F.sum(negatives).over(by_score.rangeBetween(Window.currentRow, Window.currentRow))
    beaten = F.when(F.col("label") == 1, below_or_tied.cast("double") - tied / 2).otherwise(F.lit(0.0))
    hist = hist.withColumns({"beaten": beaten, "confidence": confidence()})

    spans = with_span(hist, ["confidence", *score], ["kind"])
    k = F.lit(None).cast("int")
    for kind in kinds:
        k = F.when(F.col("kind") == kind, BUCKETS[kind]).otherwise(k)
    pieces = cut_into_tiles(spans, k)
    sums = {name: F.sum(F.col("take") * part) for name, part in confusion_flags().items()}
    sums |= {
        "n": F.sum("take"),
        "correct": F.sum(F.col("take") * is_correct()),
        "pos": F.sum(F.col("take") * flag(F.col("label") == 1)),
        "neg": F.sum(F.col("take") * flag(F.col("label") == 0)),
        "won": F.sum(F.col("take") * F.col("beaten")),
        "max_confidence": F.max("confidence"),
    }
    buckets = pieces.groupBy("kind", "bucket").agg(*[c.alias(name) for name, c in sums.items()])

    whole = Window.partitionBy("kind")
    total = {c: F.sum(c).over(whole) for c in ("n", "correct", "tp", "fp", "tn", "fn", "pos", "neg", "won")}
    scored = total["pos"].cast("double") * total["neg"].cast("double")
    return buckets.withColumns(
        {
            "all_acc": ratio(total["correct"], total["n"]),
            "all_auc": F.try_divide(total["won"], scored),
            "all_mcc": mcc(total["tp"], total["tn"], total["fp"], total["fn"]),
            **{f"all_{s}": ratio(total[s[:2]], total["n"]) for s in SHARES},
        }
    )


def _bucket_metrics() -> dict:
    """Rounded accuracy, predictive values and shares of one bucket."""
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    ppr = rounded(ratio(tp + fp, n), 3)
    return {
        "bucket_acc": rounded(ratio(F.col("correct"), n), 4),
        "ppv": F.coalesce(rounded(ratio(tp, tp + fp), 3), F.lit(0.0)),
        "npv": F.coalesce(rounded(ratio(tn, tn + fn), 3), F.lit(0.0)),
        "ppr": ppr,
        "npr": rounded(1 - ppr, 3),
        **{s: rounded(ratio(F.col(s[:2]), n), 3) for s in SHARES},
    }


def accuracy_lookup(reports: DataFrame, ds_metadata: DataFrame, kind: str = "all") -> DataFrame:
    """Per confidence bucket: accuracy, predictive values and shares, with the kind's metrics."""
    ds = newest_dataset(ds_metadata)
    m = _bucket_metrics()
    return bucket_table(reports, ds_metadata, (kind,)).select(
        "max_confidence",
        latest_version(reports).alias("model_version"),
        m["bucket_acc"].alias("bucket_acc"),
        *[rounded(F.col(f"all_{g}"), 2).alias(g) for g in ("acc", "auc", "mcc")],
        *[m[c].alias(c) for c in ("ppv", "npv", "ppr", "npr", *SHARES)],
        ds["test_start_date"].alias("test_start_date"),
        ds["test_end_date"].alias("test_end_date"),
    )


def accuracy_summary(reports: DataFrame, ds_metadata: DataFrame, kind: str = "all") -> DataFrame:
    """Per confidence bucket: unrounded accuracy, with the kind's metrics rounded to two digits."""
    ds = newest_dataset(ds_metadata)
    return bucket_table(reports, ds_metadata, (kind,)).select(
        "max_confidence",
        latest_version(reports).alias("model_version"),
        ratio(F.col("correct"), F.col("n")).alias("bucket_acc"),
        *[rounded(F.col(f"all_{g}"), 2).alias(g) for g in GLOBALS],
        ds["test_start_date"].alias("test_start_date"),
        ds["test_end_date"].alias("test_end_date"),
    )


def global_accuracy(reports: DataFrame, ds_metadata: DataFrame) -> DataFrame:
    """The metrics of non-tweets, tweets and all statements side by side; one row.

    No row when a kind has no reports, as the reference's product of the three is then empty.
    """
    per_kind = bucket_table(reports, ds_metadata, tuple(KINDS))
    cells = [
        F.max(F.when(F.col("kind") == kind, rounded(F.col(f"all_{g}"), 2))).alias(f"{kind}_{g}")
        for kind in ("nontweet", "tweet", "all")
        for g in GLOBALS
    ]
    row = per_kind.agg(*cells, F.count_distinct("kind").alias("kinds"))
    return row.where(F.col("kinds") == len(KINDS)).drop("kinds")


def global_perf_summary(reports: DataFrame, ds_metadata: DataFrame) -> DataFrame:
    """``global_accuracy`` with the model version and data set it belongs to."""
    return global_accuracy(reports, ds_metadata).select(
        latest_version(reports).alias("model_version"), newest_dataset(ds_metadata)["dsid"].alias("dsid"), "*"
    )


def local_perf_summary(reports: DataFrame, ds_metadata: DataFrame) -> DataFrame:
    """Bucket metrics of non-tweets and tweets, keyed for the history table."""
    m = _bucket_metrics()
    return bucket_table(reports, ds_metadata, ("nontweet", "tweet")).select(
        latest_version(reports).alias("model_version"),
        newest_dataset(ds_metadata)["dsid"].alias("dsid"),
        flag(F.col("kind") == "tweet").alias("stmt_type"),
        F.col("bucket").cast("int").alias("bucket_num"),
        "max_confidence",
        *[m[c].alias(c) for c in ("bucket_acc", "ppv", "npv", "ppr", "npr", *SHARES)],
    )


def published_rows(published: DataFrame, reports: DataFrame) -> DataFrame:
    """Published predictions of the latest reported model."""
    return published.where(F.col("model_version") == latest_version(reports, GROUND_TRUTH))


def published_auc(published: DataFrame, reports: DataFrame) -> DataFrame:
    """Exact AUC of published predictions against their late labels; one row."""
    return auc(published_rows(published, reports), "raw_pred", "actual_label")


def published_accuracy(
    published: DataFrame, reports: DataFrame, k: int = 10, labelled_only: bool = False
) -> DataFrame:
    """Accuracy per bucket of the stored confidence. Unlabelled rows count as wrong unless left out."""
    rows = published_rows(published, reports)
    if labelled_only:
        rows = rows.where(F.col("actual_label").isNotNull())
    correct = is_correct("actual_label").alias("correct")
    hist = rows.groupBy(F.col("raw_confidence").alias("confidence"), correct).agg(F.count(F.lit(1)).alias("n"))
    pieces = cut_into_tiles(with_span(hist, ["confidence", "correct"]), k)
    buckets = pieces.groupBy("bucket").agg(
        F.max("confidence").alias("max_confidence"),
        F.sum(F.col("take") * F.col("correct")).alias("right"),
        F.sum("take").alias("n"),
    )
    whole = Window.partitionBy()  # k rows
    return buckets.select(
        "max_confidence",
        latest_version(reports).alias("model_version"),
        ratio(F.col("right"), F.col("n")).alias("bucket_acc"),
        rounded(published_auc(published, reports).scalar(), 2).alias("auc"),
        rounded(ratio(F.sum("right").over(whole), F.sum("n").over(whole)), 2).alias("acc"),
    )
