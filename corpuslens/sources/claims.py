"""Claim pages (HTML): one row per fact-checked claim, and page totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import clean_claim, first_integer, strip
from corpuslens.sources.html import Field, Step, extract

DATE_FORMATS = (
    "MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d yy", "MMMM d yy", "d MMM yy", "d MMMM yy", "yyyy MMM d",
    "yyyy MMMM d", "M/d/yyyy", "M/d/yy", "M-d-yyyy", "M-d-yy", "yyyy-M-d", "yyyy/M/d", "yyyyMMdd")
WEEKDAY = r"(?i)\b(?:mon|tue|tues|wed|weds|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b"
ORDINAL = r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b"
CLOCK = r"(?i)(?:\s|t|\bat\s)\s*\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:[ap]\.?m\.?)?\s*(?:z|[a-z]{2,4}|[+-]\d{2}:?\d{2})?\s*$"


@dataclass(frozen=True)
class ClaimLayout:
    """Where the parts of a claim are on a claim page."""

    row: Step = Step("div", "claim-row")
    date: Step = Step("div", "dateline")
    quote: tuple[Step, ...] = (Step("p", "pg-bodyCopy has-apos"), Step("p", "pg-bodyCopy no-apos"))
    rail: Step = Step("div", "rail left")
    repeats: Step = Step("span", "repeated-total")
    details: Step = Step("div", "details not-expanded")
    marks: tuple[Step, Step] = (Step("div", "pinocchios"), Step("span", "pinocchio"))
    total: tuple[Step, Step] = (Step("h1"), Step("span", "franklin-bold red"))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date of a free-form date text; NULL when no form fits, which ``claim_rows`` rejects and counts.

    A time of day at the end, the weekday, ordinal endings, dots, commas and "of" are dropped and month names
    get one spelling; what is left is tried against ``formats``, two-digit years as 2000 and after.
    """
    plain = F.regexp_replace(strip(text), CLOCK, "")
    for pattern, to in ((WEEKDAY, " "), (ORDINAL, "$1"), (r"(?i)\bof\b", " "), (r"[.,\s]+", " ")):
        plain = F.regexp_replace(plain, pattern, to)
    plain = F.regexp_replace(F.initcap(F.trim(plain)), r"\bSept\b", "Sep")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in formats]).cast("date")


def claim_rows(pages: DataFrame, iid: int = 1, layout: ClaimLayout = ClaimLayout()) -> DataFrame:
    """All claim rows of all pages in page order, with ``reject_reason`` where a part is missing."""
    topic = (layout.rail, layout.details, Step("p"), Step("span"))
    source = (layout.rail, layout.details, Step("p", index=1), Step("span"))
    fields = [
        Field("date", (layout.date,)),
        *[Field(f"quote{i}", (step,)) for i, step in enumerate(layout.quote)],
        Field("rails", (layout.rail,), take="count"),
        Field("repeats", (layout.rail, layout.repeats)),
        Field("topic", topic),
        Field("source", source),
        Field("marks", layout.marks, take="count"),
    ]
    found = extract(pages, layout.row, fields).select("page_id", F.posexplode("rows").alias("pos", "r"))
    r = F.col("r")
    quote = F.coalesce(*[r[f"quote{i}"] for i in range(len(layout.quote))])
    date = parse_date(r["date"])
    reason = (
        F.when(r["date"].isNull(), "no_date")
        .when(date.isNull(), "bad_date")
        .when(quote.isNull(), "no_text")
        .when(r["repeats"].isNotNull() & first_integer(r["repeats"]).isNull(), "bad_repeats")
        .when(r["topic"].isNull(), "no_topic")
        .when(r["source"].isNull(), "no_source")
    )
    return found.select(
        "page_id",
        "pos",
        F.lit(iid).alias("iid"),
        clean_claim(quote).alias("statement_text"),
        F.coalesce(first_integer(r["repeats"]), F.lit(0).cast("bigint")).alias("repeats"),
        r["topic"].alias("topic"),
        r["source"].alias("source"),
        F.coalesce(r["marks"].cast("int"), F.lit(0)).alias("pinnochios"),
        date.alias("s_date"),
        reason.alias("reject_reason"),
    )


def claims(pages: DataFrame, iid: int = 1, layout: ClaimLayout = ClaimLayout()) -> DataFrame:
    """The readable claims."""
    return claim_rows(pages, iid, layout).where("reject_reason is null").drop("page_id", "pos", "reject_reason")


def claim_rejects(pages: DataFrame, layout: ClaimLayout = ClaimLayout()) -> DataFrame:
    """(page_id, pos, reject_reason) of the others."""
    return claim_rows(pages, layout=layout).where("reject_reason is not null").select("page_id", "pos", "reject_reason")


def page_totals(pages: DataFrame, layout: ClaimLayout = ClaimLayout()) -> DataFrame:
    """(page_id, total_claims): the number in the heading, thousands commas removed."""
    found = extract(pages, layout.total[0], [Field("total", layout.total[1:])])
    number = F.replace(strip(F.col("rows")[0]["total"]), F.lit(","), F.lit(""))
    return found.where(F.size("rows") > 0).select("page_id", number.try_cast("bigint").alias("total_claims"))


def page_last_dates(pages: DataFrame, layout: ClaimLayout = ClaimLayout()) -> DataFrame:
    """(page_id, last_date): the date of the page's last claim, which need not be the earliest."""
    found = extract(pages, layout.row, [Field("date", (layout.date,))])
    last = F.element_at("rows", -1)["date"]
    return found.where(F.size("rows") > 0).select("page_id", parse_date(last).alias("last_date"))
