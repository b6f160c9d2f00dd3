"""Cleaning against plain Python regular expressions on the same strings."""

import hashlib
import html
import re

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import text as tx

DASH, OPEN, CLOSE = "—", "“", "”"
SAMPLES = [
    "plain words only",
    "  padded  text  ",
    "a [note] b [two] c",
    "open [bracket\nacross] lines",
    "#tag at start and #tag after nbsp",
    "mail me @someone, now @ home",
    "dash–dash—dash--dash - end",
    "see https://example.com/a(b)c?x=1, then www.site.org/path and done.",
    "bare site.com and sub.site.co.uk/ end; not mail@site.com; node.js stays",
    "word.De next.Is x.ja. y.zz",
    "café.de éx.com",
    "â\u0080\u0098singleâ\u0080\u0099 â\u0080\u009cdoubleâ\u0080\u009d â\u0080\u0094 dash",
    "tom &amp; jerry &lt;3 &#39;quoted&#39; &nbsp;x",
    "two\nlines\tand tab",
    "‘real’ “curly”",
    "[all gone] #x @y",
    "",
    " ",
    "x",
    "\"q\"",
    "ends with dots...",
    "...starts",
    "HTTP://UPPER.COM/Path trailing",
    "http://a.b/(one)(two)/c.",
    "\x1c\x1d odd separators \x1f",
]


def url_re():
    return re.compile(tx.url_pattern().replace("(?iU)", "(?i)"))


def common(t):
    t = t.replace("â\u0080\u0094", "")
    t = t.translate(str.maketrans("", "", "\n\t"))
    for pattern in (r"\[.*?\]", r"#\S+", r"@\S+", "–|—|--"):
        t = re.sub(pattern, "", t)
    t = url_re().sub("", t)
    return re.sub("â\u0080[\u0098\u0099\u009c\u009d]", "'", t).strip()


def tweet(t):
    return common(html.unescape(t)) or None


def claim(t):
    return common(t.strip().replace(" ", " ")[1:-1])


def transcript(t):
    t = t.strip().replace(" ", " ").replace("â\u0080\u0094", "").replace('"', "")
    t = re.sub(r"\[.*?\]", "", t)
    t = re.sub("â\u0080[\u0098\u0099]", "'", t)
    t = re.sub("â\u0080[\u009c\u009d]", '"', t)
    for pattern in (r"\[.*?\]", r"#\S+", r"@\S+", "–|—|--"):
        t = re.sub(pattern, "", t)
    return t.strip()


@pytest.mark.parametrize(
    "cleaner, plain", [(tx.clean_tweet, tweet), (tx.clean_claim, claim), (tx.clean_transcript, transcript)]
)
def test_cleaning_equals_plain_python(spark, cleaner, plain):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string").repartition(3)
    got = {r.i: r.c for r in df.select("i", cleaner(F.col("t")).alias("c")).collect()}
    assert got == {i: plain(s) for i, s in enumerate(SAMPLES)}


def test_cleaning_of_test_texts(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = texts.select("text", tx.clean_tweet(F.col("text")), tx.clean_claim(F.col("text")),
                        tx.clean_transcript(F.col("text"))).collect()
    for text, a, b, c in rows:
        assert (a, b, c) == (tweet(text), claim(text), transcript(text))


def test_real_quotes_on_request(spark):
    df = spark.createDataFrame([("‘a’ “b”",)], "t string")
    assert df.select(tx.clean_transcript(F.col("t"), fix_unicode=True)).first()[0] == "'a' b"
    assert df.select(tx.clean_tweet(F.col("t"), fix_unicode=True)).first()[0] == "'a' \"b\""
    assert df.select(tx.clean_tweet(F.col("t"))).first()[0] == "‘a’ “b”"


def test_domain_list(spark):
    domains = tx.DOMAINS
    assert len(domains) == len(set(domains)) == 276
    assert {"com", "museum", "de", "uk", "eu", "ja", "su", "an", "tv"} <= set(domains)
    assert not {"bl", "bq", "cw", "mf", "um", "zz"} & set(domains)


@pytest.mark.parametrize(
    "text, words, number, decimal",
    [("one two", 2, None, None), ("", 1, None, None), ("a  b", 3, None, None), ("Repeated 1,234 times", 3, 1, 1.0),
     ("score -0.25 of 3", 4, 0, -0.25), ("x7y", 1, 7, 7.0)],
)
def test_scalars(spark, text, words, number, decimal):
    df = spark.createDataFrame([(text,)], "t string")
    t = F.col("t")
    got = df.select(tx.word_count(t), tx.first_integer(t), tx.first_decimal(t), tx.text_hash(t), tx.match_hash(t)).first()
    assert (got[0], got[1], None if got[2] is None else float(got[2])) == (words, number, decimal)
    assert got[3] == hashlib.sha1(text.encode()).hexdigest()
    assert got[4] == hashlib.sha1(text.lower().encode()).hexdigest()


def test_composite_ids(spark):
    df = spark.createDataFrame([("conv-1***12",), ("5***1000000000000000005",), ("a***b",)], "i string")
    rows = df.select(tx.first_id(F.col("i")), tx.second_id(F.col("i"))).collect()
    assert [tuple(r) for r in rows] == [("conv-1", 12), ("5", 1000000000000000005), ("a", None)]
    built = df.limit(1).select(tx.composite_id(F.lit("conv-1"), F.lit(12)), tx.tweet_url(F.lit(9))).first()
    assert tuple(built) == ("conv-1***12", "https://twitter.com/a/status/9")


def test_long_address_is_removed(spark):
    df = spark.createDataFrame([("go http://a.com/" + "x" * 100_000 + " on",)], "t string")
    assert df.select(tx.remove_urls(F.col("t"))).first()[0] == "go  on"
