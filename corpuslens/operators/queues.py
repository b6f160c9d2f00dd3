"""Work queues: statements and tweets still to be analysed or scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import tweet_url
from corpuslens.operators.corpus import WORDS, in_words


def _current_model(model_metadata: DataFrame) -> DataFrame:
    return model_metadata.where(F.col("model_version") == model_metadata.agg(F.max("model_version")).scalar())


def current_version(model_metadata: DataFrame) -> Column:
    return model_metadata.agg(F.max("model_version")).scalar()


def test_end_of_current_model(
    model_metadata: DataFrame, ds_metadata: DataFrame, ds_type: str | None = None
) -> Column:
    """Scalar: last test date of the data set the newest model was trained on."""
    sets = ds_metadata if ds_type is None else ds_metadata.where(F.col("ds_type") == ds_type)
    return _current_model(model_metadata).join(sets, "dsid").agg(F.max("test_end_date")).scalar()


def statements_to_analyse(
    statements: DataFrame,
    transcripts: DataFrame,
    published: DataFrame,
    not_published: DataFrame,
    words: tuple[int, int] = WORDS,
) -> DataFrame:
    """Statements from the newest analysed transcript date on that were not analysed.

    No rows when nothing was analysed yet, as there is then no date to start from.
    """
    analysed = published.select("tid", "sid").unionByName(not_published.select("tid", "sid"))
    known = analysed.join(statements.select("tid", "sid"), ["tid", "sid"], "left_semi").select("tid").distinct()
    newest = transcripts.join(known, "tid", "left_semi").agg(F.max("t_date")).scalar()
    recent = transcripts.where(F.col("t_date") >= newest).select("tid")
    open_rows = statements.where(in_words(words=words)).join(recent, "tid", "left_semi")
    return open_rows.join(analysed, ["tid", "sid"], "left_anti").select(
        "tid", "sid", "statement_text", F.lit(0).alias("stype")
    )


def tweets_to_analyse(
    tweets: DataFrame, published: DataFrame, not_published: DataFrame, words: tuple[int, int] = WORDS
) -> DataFrame:
    """Own tweets after the last analysed thread."""
    analysed = published.select("thread_id").unionByName(not_published.select("thread_id"))
    last = analysed.agg(F.max("thread_id")).scalar()
    rows = tweets.where((F.col("retweet") == 0) & in_words(words=words) & (F.col("thread_id") > last))
    return rows.select(
        "thread_id", F.col("end_thread_tweet_id").alias("tweet_id"), "statement_text", F.lit(1).alias("stype")
    )


def statements_to_score(
    statements: DataFrame,
    transcripts: DataFrame,
    published: DataFrame,
    model_metadata: DataFrame,
    ds_metadata: DataFrame,
    words: tuple[int, int] = WORDS,
    start_offset_days: int = 1,
) -> DataFrame:
    """Unpublished statements dated after the day that follows the current model's test dates."""
    start = F.date_add(test_end_of_current_model(model_metadata, ds_metadata), start_offset_days)
    recent = transcripts.where(F.col("t_date") > start).select("tid", "t_date", F.col("transcript_url").alias("url"))
    rows = statements.where(in_words(words=words)).join(recent, "tid")
    return rows.join(published.select("tid", "sid"), ["tid", "sid"], "left_anti").select(
        "tid", "sid", "statement_text", F.lit(0).alias("ctxt_type"), "t_date", "url"
    )


def tweets_to_score(
    tweets: DataFrame,
    published: DataFrame,
    model_metadata: DataFrame,
    ds_metadata: DataFrame,
    words: tuple[int, int] = WORDS,
    start_offset_days: int = 1,
) -> DataFrame:
    """Unpublished own tweets that ended after the day that follows the current model's test dates."""
    start = F.date_add(test_end_of_current_model(model_metadata, ds_metadata), start_offset_days)
    late = F.col("t_end_date") > start.cast("timestamp")
    rows = tweets.where((F.col("retweet") == 0) & in_words(words=words) & late)
    return rows.join(published.select("thread_id"), "thread_id", "left_anti").select(
        "thread_id",
        "end_thread_tweet_id",
        "statement_text",
        F.lit(1).alias("ctxt_type"),
        "t_end_date",
        tweet_url(F.col("end_thread_tweet_id")).alias("url"),
    )
