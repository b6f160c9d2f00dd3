"""Message timelines landed as JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import DOMAINS, clean_tweet, continues, more_follows

TIMELINE_SCHEMA = (
    "id bigint, user_id bigint, created_at string, full_text string, retweeted_status struct<full_text string>"
)

API_TIME = "MMM dd HH:mm:ss Z yyyy"  # after the weekday, as in "Wed Oct 10 20:19:24 +0000 2018"


def _timestamp(text: Column) -> Column:
    """ISO times, or the interface's own form; NULL for anything else."""
    return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(F.substr(text, F.lit(5)), F.lit(API_TIME)))


def _rows(lines: DataFrame, column: str) -> DataFrame:
    """Parsed lines with ``ts`` and ``reject_reason``.

    The rows come out of an ``inline``, which no filter is pushed through, so a line is parsed and its time read once.
    """

    def read(j: Column) -> Column:
        return F.transform(F.array(_timestamp(j["created_at"])), lambda ts: F.struct(
            j["id"].alias("id"), j["user_id"].alias("user_id"), j["created_at"].alias("created_at"), j["full_text"].alias("full_text"),
            j["retweeted_status"].alias("retweeted_status"), ts.alias("ts"),
            F.when(j["id"].isNull(), "no_id").when(ts.isNull(), "bad_time").alias("reject_reason")))

    parsed = F.flatten(F.transform(F.array(F.from_json(column, TIMELINE_SCHEMA)), read))
    return lines.select(F.inline(parsed))


def timeline(lines: DataFrame, column: str = "value", domains: Sequence[str] = DOMAINS) -> DataFrame:
    """(author, tweet_id, text, ts, is_rt, more, cont) of messages with text left after cleaning.

    A repost carries the text of the message it repeats. Messages without a readable id or time are left to
    ``timeline_rejects``.
    """
    row = _rows(lines, column).where("reject_reason is null")
    is_rt = F.col("retweeted_status").isNotNull()
    raw = F.when(is_rt, F.col("retweeted_status.full_text")).otherwise(F.col("full_text"))
    text = F.explode(F.array_compact(F.array(clean_tweet(raw, domains))))  # drops the rows without text
    cleaned = row.select(
        F.col("user_id").alias("author"),
        F.col("id").alias("tweet_id"),
        text.alias("text"),
        F.col("ts"),
        is_rt.alias("is_rt"),
    )
    return cleaned.withColumns({"more": more_follows(F.col("text")), "cont": continues(F.col("text"))})


def timeline_rejects(lines: DataFrame, column: str = "value") -> DataFrame:
    """(author, tweet_id, created_at, reject_reason) of messages that ``timeline`` leaves out for a missing id or time."""
    found = _rows(lines, column).where("reject_reason is not null")
    return found.select(F.col("user_id").alias("author"), F.col("id").alias("tweet_id"), "created_at", "reject_reason")
