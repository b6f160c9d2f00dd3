"""Late labels: claims that turn out to match published statements, and their write-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import first_id, second_id
from corpuslens.operators.corpus import last_claim_date
from corpuslens.operators.queues import current_version, test_end_of_current_model
from corpuslens.plans.slices import CONVERGED


def new_claims(claims: DataFrame, model_metadata: DataFrame, ds_metadata: DataFrame) -> DataFrame:
    """Claims dated after the current model's test dates."""
    end = test_end_of_current_model(model_metadata, ds_metadata, CONVERGED)
    return claims.where(F.col("s_date") > end)


def _nearest(claims: DataFrame, pairs: DataFrame, truths: DataFrame, ids: list[str]) -> DataFrame:
    """Per claim the nearest pair whose truth exists, ties by truth id.

    Pairs of other claims go first. Only ids and distances travel until one pair per claim is left; a claim with
    very many pairs is reduced to one before the shuffle by partial aggregation.
    """
    wanted = pairs.join(claims.select(F.col("sid").alias("falsehood_id")), "falsehood_id", "left_semi")
    existing = wanted.join(truths.select(*ids), ids, "left_semi")
    order = F.struct("l2dist", *ids)
    nearest = existing.groupBy("falsehood_id").agg(F.min(order).alias("m")).select("falsehood_id", "m.*")
    found = nearest.join(
        claims.select(F.col("sid").alias("falsehood_id"), "s_date", F.col("statement_text").alias("falsehood_text")),
        "falsehood_id",
    )
    return found.join(truths.select(*ids, F.col("statement_text").alias("truth_text")), ids)


def scored_false_statements(
    claims: DataFrame,
    candidates: DataFrame,
    statements: DataFrame,
    model_metadata: DataFrame,
    ds_metadata: DataFrame,
    max_dist: float = 0.04,
) -> DataFrame:
    """New claims with their nearest transcript statement closer than ``max_dist``."""
    pairs = candidates.where(F.col("l2dist") < max_dist).select(
        "falsehood_id",
        "l2dist",
        first_id(F.col("truth_id")).alias("tid"),
        second_id(F.col("truth_id")).alias("sid"),
    )
    recent = new_claims(claims, model_metadata, ds_metadata)
    return _nearest(recent, pairs, statements, ["tid", "sid"]).select(
        F.col("l2dist").alias("min_l2dist"),
        F.col("falsehood_id").alias("thread_id"),
        "s_date",
        "tid",
        F.col("sid").cast("bigint").alias("sid"),
        "falsehood_text",
        "truth_text",
    )


def scored_false_tweets(
    claims: DataFrame,
    candidates: DataFrame,
    tweets: DataFrame,
    model_metadata: DataFrame,
    ds_metadata: DataFrame,
    max_dist: float = 0.04,
) -> DataFrame:
    """New claims with their nearest tweet thread closer than ``max_dist``."""
    pairs = candidates.where(F.col("l2dist") < max_dist).select(
        "falsehood_id",
        "l2dist",
        first_id(F.col("truth_id")).try_cast("bigint").alias("thread_id"),
        second_id(F.col("truth_id")).alias("end_thread_tweet_id"),
    )
    recent = new_claims(claims, model_metadata, ds_metadata)
    return _nearest(recent, pairs, tweets, ["thread_id", "end_thread_tweet_id"]).select(
        F.col("l2dist").alias("min_l2dist"),
        F.col("falsehood_id").alias("f_thread_id"),
        "s_date",
        "thread_id",
        "falsehood_text",
        "truth_text",
    )


def _published_matches(
    scored: DataFrame, published: DataFrame, model_metadata: DataFrame, claims: DataFrame, ids: list[str]
) -> DataFrame:
    current = published.where(F.col("model_version") == current_version(model_metadata))
    up_to_last = scored.where(F.col("s_date") <= last_claim_date(claims, None))
    return current.select(*ids, "model_version").join(up_to_last.select(*ids, "s_date"), ids)


def published_statement_updates(
    scored: DataFrame, published: DataFrame, model_metadata: DataFrame, claims: DataFrame
) -> DataFrame:
    """Matched statements that the current model had published."""
    rows = _published_matches(scored, published, model_metadata, claims, ["tid", "sid"])
    return rows.select("tid", "sid", "s_date", "model_version")


def published_tweet_updates(
    scored: DataFrame, published: DataFrame, model_metadata: DataFrame, claims: DataFrame
) -> DataFrame:
    """Matched tweets that the current model had published."""
    rows = _published_matches(scored, published, model_metadata, claims, ["thread_id"])
    return rows.select("thread_id", "s_date", "model_version")


def published_statement_nonlabel_updates(
    published: DataFrame,
    statements: DataFrame,
    transcripts: DataFrame,
    claims: DataFrame,
    model_metadata: DataFrame,
    ds_metadata: DataFrame,
) -> DataFrame:
    """Published statements dated after the test dates, up to the last claim."""
    low = test_end_of_current_model(model_metadata, ds_metadata, CONVERGED)
    dated = transcripts.where((F.col("t_date") > low) & (F.col("t_date") <= last_claim_date(claims, None)))
    rows = published.select("tid", "sid").join(dated.select("tid", "t_date"), "tid")
    return rows.join(statements.select("tid", "sid"), ["tid", "sid"], "left_semi").select("tid", "sid", "t_date")


def published_tweet_nonlabel_updates(
    published: DataFrame, tweets: DataFrame, claims: DataFrame, model_metadata: DataFrame, ds_metadata: DataFrame
) -> DataFrame:
    """Published tweets that ended after the test dates, up to the last claim."""
    low = test_end_of_current_model(model_metadata, ds_metadata, CONVERGED).cast("timestamp")
    high = last_claim_date(claims, None).cast("timestamp")
    dated = tweets.where((F.col("t_end_date") > low) & (F.col("t_end_date") <= high))
    return dated.select("thread_id", "t_end_date").join(published.select("thread_id"), "thread_id")


def with_late_labels(
    published: DataFrame, updates: DataFrame, nonlabel_updates: DataFrame, ids: list[str], score_date: Column
) -> DataFrame:
    """Published rows with label 1 where a claim matched, else 0 where the claims now cover their date.

    Rows outside both keep the label and score date they have.
    """
    false_ids = updates.select(*ids).distinct().withColumn("matched", F.lit(1))
    checked_ids = nonlabel_updates.select(*ids).distinct().withColumn("checked", F.lit(0))
    joined = published.join(false_ids, ids, "left").join(checked_ids, ids, "left")
    late = F.coalesce("matched", "checked")
    return joined.withColumns(
        {
            "actual_label": F.coalesce(late, "actual_label"),
            "score_date": F.when(late.isNotNull(), score_date).otherwise(F.col("score_date")),
        }
    ).select(*published.columns)
