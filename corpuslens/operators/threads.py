"""Joining messages that continue each other into threads.

Input rows: author, tweet_id, text, ts, is_rt, more. A message that ends in dots opens a
thread; later ones of the author are appended while less than ``latency`` seconds have passed
since the thread's first message, and the first one without dots closes it. Reposts pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import drop_leading_dots, drop_trailing_dots
from corpuslens.plans.skew import lookup_join
from corpuslens.session import materialise

# times are microseconds since 1970 while rows are in Python
_FOLDED = (
    "author bigint, end_id bigint, last_id bigint, text string, t_start bigint, t_end bigint, stop_id bigint"
)
_FOLDED_COLUMNS = ["author", "end_id", "last_id", "text", "t_start", "t_end", "stop_id"]


class OpenThread:
    """The thread an author has open: its start, its ids and its pieces so far."""

    def __init__(self, compat: bool):
        self.compat = compat
        self.pieces: list[str] = []
        self.start = self.first_id = self.last_id = self.last_ts = None

    def open(self, tweet_id: int, ts, piece: str) -> None:
        self.start, self.first_id, self.pieces = ts, tweet_id, []
        self.append(tweet_id, ts, piece)

    def append(self, tweet_id: int, ts, piece: str) -> None:
        self.last_id, self.last_ts = tweet_id, ts
        self.pieces.append(piece)

    def joined(self) -> str:
        text = " ".join(self.pieces)
        return " " + text if self.compat else text

    def close(self) -> tuple:
        row = (self.last_id, self.last_id, self.joined(), self.start, self.last_ts)
        self.start = None
        return row

    def expire(self) -> tuple:
        """Close for age. In compat mode the row carries the first message's id and time."""
        first = (self.first_id, self.last_id, self.joined(), self.start, self.start)
        row = first if self.compat else (self.last_id, self.last_id, self.joined(), self.start, self.last_ts)
        self.start = None
        return row


def step(thread: OpenThread, tweet_id: int, ts, text: str, piece: str, more: int, latency) -> list[tuple]:
    """Feed one own message; returns the finished rows (end_id, last_id, text, t_start, t_end).

    ``ts`` and ``latency`` may be numbers, or a timestamp and a duration.
    """
    done = []
    if thread.start is not None:
        if ts - thread.start < latency:
            thread.append(tweet_id, ts, piece)
            return done if more else [thread.close()]
        done.append(thread.expire())
    if more:
        thread.open(tweet_id, ts, piece)
    else:
        done.append((tweet_id, tweet_id, text, ts, ts))
    return done


def _fold(latency: int, young: int, compat: bool):
    """Stream rows sorted by (author, seg, tweet_id) through one open thread at a time.

    A segment that is one finished message is passed on as a column; only the others are stepped through.
    """
    columns = ["author", "seg", "tweet_id", "ts", "text", "piece", "more", "goes_on"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, thread, stopped, later = None, OpenThread(compat), False, False

        def aged(author) -> list[tuple]:
            """The thread left open, closed for age by the author's next message, which opens the next segment."""
            return [(author, *thread.expire(), None)] if later and not stopped and thread.start is not None else []

        for batch in batches:
            alone = (batch["size"] == 1) & (batch["more"] == 0)
            one = batch[alone]
            yield pd.DataFrame(
                {
                    "author": one["author"], "end_id": one["tweet_id"], "last_id": one["tweet_id"],
                    "text": one["text"], "t_start": one["ts"], "t_end": one["ts"], "stop_id": None,
                }
            )
            out, rest = [], batch[~alone]
            for author, seg, tweet_id, ts, text, piece, more, goes_on in zip(*(rest[c].tolist() for c in columns)):
                if (author, seg) != key:
                    out += aged(key[0]) if key else []
                    key, thread, stopped, later = (author, seg), OpenThread(compat), False, goes_on
                if stopped:
                    continue
                before = thread.first_id if thread.start is not None else None
                out += [(author, *row, None) for row in step(thread, tweet_id, ts, text, piece, more, latency)]
                opened = thread.start is not None and thread.first_id != before
                if opened and ts > young:
                    out.append((author, None, None, None, None, None, tweet_id))
                    stopped = True
            yield pd.DataFrame(out, columns=_FOLDED_COLUMNS, dtype=object)
        if key:
            yield pd.DataFrame(aged(key[0]), columns=_FOLDED_COLUMNS, dtype=object)

    return run


def own_messages(tweets: DataFrame) -> DataFrame:
    """Messages that are not reposts, without leading dots, and with the text as a thread piece."""
    text = drop_leading_dots(F.col("text"))
    own = tweets.where(~F.col("is_rt")).withColumn("text", text)
    return own.withColumn("piece", drop_trailing_dots(F.col("text")))


def with_segments(own: DataFrame, latency: int) -> DataFrame:
    """Number the stretches that threads cannot cross (``seg``) and say where the author goes on behind one (``goes_on``).

    A stretch ends behind a message without dots, and before a message that is ``latency`` or more later than all
    messages before it: whatever thread is open then is too old to go on. Rows are laid out in sampled ranges of
    (author, tweet_id), so one author's rows are never sorted in one task; inside a range both kinds of ends
    are found by running windows, and what a window needs from earlier ranges is carried over by one row per author and range.
    """
    placed = materialise(own.repartitionByRange("author", "tweet_id").withColumn("range", F.spark_partition_id()))
    key = ["author", "range"]
    totals = placed.groupBy(*key).agg(
        F.max("ts").alias("top"), F.max_by("more", "tweet_id").alias("last_more"), F.max("tweet_id").alias("last_id"))
    ranges = Window.partitionBy("author").orderBy("range")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = totals.select(
        *key, F.max("top").over(ranges.rowsBetween(Window.unboundedPreceding, -1)).alias("top_before"),
        F.lag("last_more").over(ranges).alias("more_before"), F.max("last_id").over(whole).alias("author_last"))
    within = Window.partitionBy(*key).orderBy("tweet_id")
    newest = F.greatest("top_before", F.max("ts").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    follows = F.coalesce(F.lag("more").over(within), F.col("more_before")) == 1
    cut = ~F.coalesce(follows & (F.col("ts") - newest < latency), F.lit(False))
    marked = materialise(placed.join(carried, key).withColumn("cut", cut.cast("int")).drop("top_before", "more_before"))
    cuts = marked.groupBy(*key).agg(F.sum("cut").alias("cuts"))
    offsets = cuts.select(*key, F.coalesce(
        F.sum("cuts").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    here = F.sum("cut").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = marked.withColumn("here", here).join(offsets, key)
    return counted.withColumns({"seg": F.col("offset") + F.col("here")}).drop("range", "cut", "here", "offset")


def build_threads(
    tweets: DataFrame, latency_seconds: int, now: datetime, compat: bool = True
) -> DataFrame:
    """(author, end_id, text, t_start, t_end, is_rt) of finished threads and single messages.

    ``now`` is in UTC, without a zone.

    A message that would open a thread younger than ``latency`` at ``now`` holds back itself and all
    later messages of its author. ``compat=False`` drops two quirks kept by default: the leading
    blank of joined text, and the first id and time on threads closed by age.
    """
    latency = latency_seconds * 1_000_000
    young = (now - datetime(1970, 1, 1)) // timedelta(microseconds=1) - latency
    by_segment = Window.partitionBy("author", "seg").orderBy("tweet_id")
    whole = by_segment.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sized = (
        with_segments(own_messages(tweets).withColumn("ts", F.unix_micros("ts")), latency)
        .withColumns({"size": F.count(F.lit(1)).over(whole), "newest": F.max("ts").over(whole),
                      "goes_on": F.max("tweet_id").over(whole) < F.col("author_last")})
        .select("author", "seg", "tweet_id", "ts", "text", "piece", "more", "size", "newest", "goes_on")
        .sortWithinPartitions("author", "seg", "tweet_id")  # the order the window leaves; costs nothing
    )
    fold = _fold(latency, young, compat)
    finished = (
        sized.mapInPandas(fold, _FOLDED)
        .where(F.col("end_id").isNotNull())
        .withColumns({"t_start": F.timestamp_micros("t_start"), "t_end": F.timestamp_micros("t_end")})
        .withColumn("is_rt", F.lit(False))
    )
    reposts = tweets.where(F.col("is_rt")).select(
        "author",
        F.col("tweet_id").alias("end_id"),
        F.col("tweet_id").alias("last_id"),
        "text",
        F.col("ts").alias("t_start"),
        F.col("ts").alias("t_end"),
        F.lit(None).cast("bigint").alias("stop_id"),
        "is_rt",
    )
    # only segments that reach into the last ``latency`` seconds can hold back anything
    recent = sized.where(F.col("newest") > young).mapInPandas(fold, _FOLDED)
    stops = recent.groupBy("author").agg(F.min("stop_id").alias("author_stop")).where("author_stop is not null")
    rows = lookup_join(finished.unionByName(reposts), stops, ["author"], ["last_id"], "left", count_on=tweets)
    before_stop = F.col("author_stop").isNull() | (F.col("last_id") < F.col("author_stop"))
    return rows.where(before_stop).select("author", "end_id", "text", "t_start", "t_end", "is_rt")
