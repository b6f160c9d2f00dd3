import datetime
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslens.sources import claims, metadata, transcripts, tweets
from corpuslens.sources.html import Field, Step, extract


def block(speaker, text, score, cls="media topic-media-row mediahover odd"):
    return (
        f"<div class='{cls}'><div class='speaker-label'>{speaker}</div>"
        f"<div class='transcript-text-block'>{text}</div><div class='sentiment-block'><p>x</p></div>"
        f"<div title='{score}'></div></div>"
    )


def test_transcript_page(spark):
    page = "<html><script>var t='</div><div class=\"media topic-media-row mediahover\">';</script>" + "".join(
        [
            block("Anna", " First [applause] one &amp; \"two\" ", "Score 0.25"),
            block("Other", "not hers", "0.5"),
            block("Anna", "unscored", "Unknown"),
            block("Anna", "minus", "very -0.5 low"),
            block("Anna", "no number", "rated high"),
            "<div class='media topic-media-row mediahover'><p>no speaker</div>",
            block("Anna", "other class", "0.1", cls="media topic-media-row"),
            "<div class='media topic-media-row mediahover'><div class='speaker-label'>Anna</div></div>",
            block("Anna", "last", "1"),
        ]
    )
    pages = spark.createDataFrame([("t1", page), ("t2", "<p>nothing"), ("t3", None)], "tid string, html string")
    rows = transcripts.transcript_statements(pages, "Anna").collect()
    assert [(r.tid, r.sid, r.statement_text, float(r.sentiment)) for r in rows] == [
        ("t1", 0, "First  one & two", 0.25), ("t1", 1, "minus", -0.5), ("t1", 2, "last", 1.0),
    ]
    rejects = transcripts.transcript_rejects(pages, "Anna").collect()
    assert [(r.pos, r.reason) for r in rejects] == [(4, "bad_sentiment"), (5, "no_speaker"), (6, "no_text")]


CLAIM = """
<div class="claim-row wide"><div class="dateline">Jan. 20, 2017</div>
  <p class="pg-bodyCopy has-apos">“We have [the] best #jobs — see www.site.com/xy now”</p>
  <div class="rail left"><span class="repeated-total">Repeated 1,234 times</span>
    <div class="details not-expanded"><p>Topic: <span>Jobs</span><p>Source: <span>Twitter</span></div></div>
  <div class="pinocchios"><span class="pinocchio"></span><span class="pinocchio"></span></div></div>"""


def test_claim_page(spark):
    plain = CLAIM.replace("has-apos", "no-apos").replace("Jan. 20, 2017", "March 3, 2018")
    plain = plain.replace('<span class="repeated-total">Repeated 1,234 times</span>', "")
    bad_date = CLAIM.replace("Jan. 20, 2017", "some day")
    no_date = CLAIM.replace('<div class="dateline">Jan. 20, 2017</div>', "")
    no_text = CLAIM.replace("has-apos", "other")
    bad_repeats = CLAIM.replace("1,234", "many")
    html = "<h1>All <span class='franklin-bold red'> 13,435 </span></h1>" + CLAIM + plain + bad_date + no_date + no_text + bad_repeats
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = claims.claims(pages).collect()
    day = datetime.date
    assert [tuple(r) for r in rows] == [
        (1, "We have  best   see  now", 1, "Jobs", "Twitter", 2, day(2017, 1, 20)),
        (1, "We have  best   see  now", 0, "Jobs", "Twitter", 2, day(2018, 3, 3)),
    ]
    rejects = claims.claim_rejects(pages).collect()
    assert [(r.pos, r.reject_reason) for r in rejects] == [
        (2, "bad_date"), (3, "no_date"), (4, "no_text"), (5, "bad_repeats"),
    ]
    assert claims.page_totals(pages).first().total_claims == 13435
    assert claims.page_last_dates(pages).first().last_date == day(2017, 1, 20)


@pytest.mark.parametrize("text", ["Jan 20, 2017", "January 20, 2017", "Jan. 20 2017", "20 Jan 2017", "1/20/2017",
                                  "2017-01-20", "  January  20,  2017 "])
def test_dates(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(claims.parse_date(F.col("t"))).first()[0] == datetime.date(2017, 1, 20)


def test_other_layouts_by_selector(spark):
    """The raw test pages: unclosed tags, scripts with markup in strings, one article each."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    fields = [Field("title", (Step("h1"),)), Field("paragraphs", (Step("p"),), take="count"), Field("first", (Step("p"),))]
    rows = extract(pages, Step("article"), fields).collect()
    assert len(rows) == pages.count()
    found = [r["rows"][0] for r in rows if r["rows"]]
    assert found and all(f["title"] and int(f["paragraphs"]) > 0 for f in found)
    assert not any("track(" in (f["first"] or "") for f in found)


@pytest.mark.parametrize(
    "score, kept", [(0.25, 0.25), (-1, -1.0), ("0.5", 0.5), ("0", 0.0), (0, None), (0.0, None), ("", None), (None, None),
                    (False, None), ("Unknown", None)],
)
def test_index_keeps_scored_entries(spark, score, kept):
    entry = {"id": "a", "date": "2020-02-03", "type": "Speech", "slug": "s-1", "sentiment": {"score": score}}
    page = json.dumps({"data": [entry], "other": 1})
    df = spark.createDataFrame([(page,)], "value string")
    rows = [tuple(r) for r in transcripts.transcript_index(df, "https://example.org/t/").collect()]
    if kept is None:
        assert rows == []
    else:
        assert [(*r[:4], float(r[4])) for r in rows] == [
            ("a", datetime.date(2020, 2, 3), "Speech", "https://example.org/t/s-1", kept)
        ]


def test_timeline(spark):
    def line(i, text, repeated=None):
        row = {"id": i, "user_id": 7, "created_at": "2024-01-01T00:00:00Z", "full_text": text}
        return (json.dumps(row | ({"retweeted_status": {"full_text": repeated}} if repeated else {})),)

    lines = [line(1, "plain &amp; simple"), line(2, "RT cut", "the whole ..."), line(3, "@only #tags"), line(4, "..go on..")]
    rows = tweets.timeline(spark.createDataFrame(lines, "value string")).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.text, r.is_rt, r.more, r.cont) for r in rows] == [
        (1, "plain & simple", False, 0, 0), (2, "the whole ...", True, 1, 0), (4, "..go on..", False, 1, 1),
    ]


def test_message_times(spark):
    times = ["2018-10-10T20:19:24Z", "Wed Oct 10 20:19:24 +0000 2018", "Wed Oct 10 22:19:24 +0200 2018", "soon"]
    lines = [(json.dumps({"id": i, "user_id": 1, "created_at": t, "full_text": "x"}),) for i, t in enumerate(times)]
    rows = tweets.timeline(spark.createDataFrame(lines, "value string")).orderBy("tweet_id").collect()
    assert [r.ts for r in rows] == [datetime.datetime(2018, 10, 10, 20, 19, 24)] * 3  # the last has no time: rejected


def test_split_dates(spark, tmp_path):
    names = [f"{p}_{e}_date" for p in ("train", "val", "test") for e in ("start", "end")]
    path = tmp_path / "meta.json"
    path.write_text(json.dumps({n: f"2020-0{i + 1}-01" for i, n in enumerate(names)}, indent=2))
    row = metadata.split_dates(spark, str(path)).first()
    assert row.asDict() == {n: datetime.date(2020, i + 1, 1) for i, n in enumerate(names)}


@pytest.mark.parametrize("text, day", [
    ("Sept. 20, 2019", (2019, 9, 20)), ("Monday, January 20, 2020", (2020, 1, 20)), ("1/20/17", (2017, 1, 20)),
    ("Jan 5th, 2019", (2019, 1, 5)), ("2019/01/05", (2019, 1, 5)), ("Jan 05, 2019 10:30", (2019, 1, 5)),
    ("JAN 5 2019 at 10:30 p.m. EST", (2019, 1, 5)), ("2019-01-05T10:30:00Z", (2019, 1, 5)), ("the 3rd of March 2018", None),
    ("3rd of March 2018", (2018, 3, 3)), ("20 Sep 2019", (2019, 9, 20)), ("no date", None), (None, None),
])
def test_free_form_dates(spark, text, day):
    import datetime

    from corpuslens.sources.claims import parse_date

    got = spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()[0]
    assert got == (day and datetime.date(*day))


def test_messages_without_id_or_time_are_rejected(spark):
    rows = [{"id": 1, "user_id": 7, "created_at": "2020-01-01 10:00:00", "full_text": "a"},
            {"id": 2, "user_id": 7, "created_at": "some day", "full_text": "b"}, {"user_id": 8, "created_at": "2020-01-01", "full_text": "c"}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    assert [r.tweet_id for r in tweets.timeline(lines).collect()] == [1]
    assert sorted((r.author, r.tweet_id, r.reject_reason) for r in tweets.timeline_rejects(lines).collect()) == [
        (7, 2, "bad_time"), (8, None, "no_id")]


def test_plain_pages_read_like_the_parser():
    from corpuslens.sources.html import _Page

    class Slow(_Page):
        def _read_plain(self, page):
            return False

    rng, plain = random.Random(8), 0
    pieces = [
        "<div class='a b'>", "<div class=\"a\">", "</div>", "<p>", "</p>", "<span title='x y'>", "</span>", "<br>", "<br/>", "<img src='q'/>",
        "text ", "a &amp; b &eacute &#39;", "\n", "<h1>", "</h1>", "<script>var t='<div class=\"a\">';</script>", "<style>p {}</style>",
        "<!-- note -->", "<!DOCTYPE html>", "</nothing>", "<p class='' id=\"2\">", "&", "“ "]
    odd = ["<DIV CLASS=a>", "< b", "<!-- a - b -->", "<script>'</div>'</script>", "<title><p>t</title>", "<a href='x&amp;y'>", "<script/>", "<", "<a b>",
           "<textarea>", "<script>", "</p >", "<p\tclass='a'>", "<!-->", "<style>", "</", "<p class='a'id='b'>", "&am"]
    for n in range(1500):
        page = "".join(rng.choice(odd if n % 2 and rng.random() < 0.15 else pieces) for _ in range(rng.randrange(1, 30)))
        fast, slow = _Page(page), Slow(page)
        plain += fast.rawdata == "" and not slow.get_starttag_text() is None and fast.get_starttag_text() is None
        assert [(e.tag, e.attrs, e.place, e.last, e.text()) for e in fast.elements] == [
            (e.tag, e.attrs, e.place, e.last, e.text()) for e in slow.elements], page
    assert plain > 500


def test_rows_of_pages_leave_in_small_batches():
    """A task holds a page and a small batch of rows, whatever the number of pages in its Arrow batch."""
    from corpuslens.sources.html import _OUT_CHARS, reader

    page = "<div class='row'><p>" + "x" * 9000 + "</p></div>" + "<div class='row'></div>"
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(1000)), "html": [page if n % 3 else None for n in range(1000)]})
    fields = [Field("said", (Step("p"),)), Field("n", (Step("p"),), "count")]
    out = list(reader(Step("div", "row"), fields, ["page_id"], "html")(iter([batch])))
    assert len(out) > 4 and all(b.nbytes < 2 * _OUT_CHARS for b in out)
    rows = [(r["page_id"], [(x["said"], x["n"]) for x in r["rows"]]) for b in out for r in b.to_pylist()]
    assert rows == [(n, [("x" * 9000, "1"), (None, "0")] if n % 3 else []) for n in range(1000)]
