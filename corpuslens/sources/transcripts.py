"""Transcript index pages (JSON) and transcript pages (HTML)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import clean_transcript, first_decimal
from corpuslens.sources.html import Field, Step, extract

UNSCORED = "Unknown"
INDEX_SCHEMA = (
    "data array<struct<id string, date string, type string, slug string, sentiment struct<score variant>>>"
)


def _is_truthy(score: Column) -> Column:
    """False for null, false, the empty string and the number zero; the string "0" counts as a score."""
    kind, text = F.schema_of_variant(score), F.variant_get(score, "$", "string")
    number_zero = ~kind.isin("STRING", "BOOLEAN") & (F.try_variant_get(score, "$", "double") == 0)
    empty = text.isNull() | (text == "") | ((kind == "BOOLEAN") & (text == "false")) | F.coalesce(number_zero, F.lit(False))
    return ~F.coalesce(empty, F.lit(True))


def transcript_index(pages: DataFrame, base_url: str, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Entries of index pages whose sentiment has been scored: (tid, t_date, type, url, sentiment) and the page's columns ``keep``."""
    entry = pages.select(*keep, F.explode(F.from_json(column, INDEX_SCHEMA)["data"]).alias("e"))
    score = F.col("e.sentiment.score")
    text = F.variant_get(score, "$", "string")
    return entry.where(_is_truthy(score) & (text != UNSCORED)).select(
        F.col("e.id").alias("tid"),
        F.col("e.date").try_cast("date").alias("t_date"),
        F.col("e.type").alias("transcript_type"),
        F.concat(F.lit(base_url), F.col("e.slug")).alias("transcript_url"),
        text.try_cast("decimal(5,2)").alias("transcript_sent"),
        *keep,
    )


@dataclass(frozen=True)
class TranscriptLayout:
    """Where the parts of a statement are on a transcript page."""

    block: Step = Step("div", "media topic-media-row mediahover", contains=True)
    speaker: Step = Step("div", "speaker-label")
    text: Step = Step("div", "transcript-text-block")
    sentiment: Step = Step("div", "sentiment-block")


def _blocks(pages: DataFrame, layout: TranscriptLayout) -> DataFrame:
    fields = [
        Field("speaker", (layout.speaker,)),
        Field("text", (layout.text,)),
        Field("sentiment", (layout.sentiment,), take="next", next_tag="div", attribute="title"),
        Field("sentiment_blocks", (layout.sentiment,), take="count"),
    ]
    return extract(pages, layout.block, fields, keep=("tid",))


def transcript_statements(pages: DataFrame, speaker: str, layout: TranscriptLayout = TranscriptLayout()) -> DataFrame:
    """(tid, sid, statement_text, sentiment) of one speaker's scored statements, numbered from 0.

    Numbers count kept statements only, inside the page's own array, so no page is sorted.
    """

    def kept(block: Column) -> Column:
        scored = block["sentiment"].isNotNull() & ~block["sentiment"].isin("", UNSCORED)
        return (
            (block["speaker"] == speaker)
            & block["text"].isNotNull()
            & scored
            & first_decimal(block["sentiment"]).isNotNull()
        )

    numbered = _blocks(pages, layout).select("tid", F.posexplode(F.filter("rows", kept)).alias("sid", "b"))
    return numbered.select(
        "tid",
        "sid",
        clean_transcript(F.col("b.text")).alias("statement_text"),
        first_decimal(F.col("b.sentiment")).alias("sentiment"),
    )


def transcript_rejects(pages: DataFrame, speaker: str, layout: TranscriptLayout = TranscriptLayout()) -> DataFrame:
    """(tid, pos, reason) of blocks that could not be read; unscored ones and other speakers are no errors."""
    b = F.col("b")
    own = b["speaker"] == speaker
    rated = b["sentiment"].isNotNull() & ~b["sentiment"].isin("", UNSCORED)
    reason = (
        F.when(b["speaker"].isNull(), "no_speaker")
        .when(own & b["text"].isNull(), "no_text")
        .when(own & (b["sentiment_blocks"] == "0"), "no_sentiment")
        .when(own & rated & first_decimal(b["sentiment"]).isNull(), "bad_sentiment")
    )
    found = _blocks(pages, layout).select("tid", F.posexplode("rows").alias("pos", "b"))
    return found.select("tid", "pos", reason.alias("reason")).where("reason is not null")
