"""Text columns: word counts, hashes, composite ids, and the three cleaning chains.

The chains run as regular expressions inside the JVM; only HTML entities need Python. White
space means what Python's ``str.strip`` and ``\\s`` mean, spelled out because Java's classes differ.
"""

from __future__ import annotations

import html
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns, marks and word lists whose exact form decides the results.
SPACE = r"\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BRACKETED = r"(?d)\[.*?\]"
HASHTAG = rf"#[^{SPACE}]+"
HANDLE = rf"@[^{SPACE}]+"
DASHES = r"\x{2013}|\x{2014}|--"
MANGLED_EM_DASH = "â\u0080\u0094"
MANGLED_SINGLE_QUOTES = r"\x{E2}\x{80}[\x{98}\x{99}]"
MANGLED_DOUBLE_QUOTES = r"\x{E2}\x{80}[\x{9C}\x{9D}]"
MORE_FOLLOWS = r"\.{2,}\z"
CONTINUES = r"^\.{2,}"
FIRST_INTEGER = r"[0-9]+"
FIRST_DECIMAL = r"-?[0-9]+(\.[0-9]+)?"
TWEET_URL = "https://twitter.com/a/status/"
ID_MARK = "***"
DOMAINS = tuple("""
com net org edu gov mil aero asia biz cat coop info int jobs mobi museum name post pro tel travel xxx
ac ad ae af ag ai al am an ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bv bw by bz
ca cc cd cf cg ch ci ck cl cm cn co cr cs cu cv cx cy cz dd de dj dk dm do dz ec ee eg eh er es et eu fi fj fk fm fo fr
ga gb gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it
ja je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly
ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om
pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz
tc td tf tg th tj tk tl tm tn to tp tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt yu za zm zw
""".split())


def word_count(text: Column) -> Column:
    """Number of blanks plus one; counted in bytes, which needs no decoding and differs by blanks only."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("int")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def text_hash(text: Column) -> Column:
    return F.sha1(text)


def match_hash(text: Column) -> Column:
    """Hash that ignores case, for finding the same statement in both classes."""
    return F.sha1(F.lower(text))


def composite_id(first: Column, second: Column) -> Column:
    return F.concat(first.cast("string"), F.lit(ID_MARK), second.cast("string"))


def first_id(truth_id: Column) -> Column:
    return F.substring_index(truth_id, ID_MARK, 1)


def second_id(truth_id: Column) -> Column:
    """The part after the mark as a number; NULL when it is none."""
    return F.substring_index(truth_id, ID_MARK, -1).try_cast("bigint")


def tweet_url(tweet_id: Column) -> Column:
    return F.concat(F.lit(TWEET_URL), tweet_id.cast("string"))


def first_integer(text: Column) -> Column:
    """First run of digits; NULL when there is none. A thousands comma ends the run."""
    return F.nullif(F.regexp_extract(text, FIRST_INTEGER, 0), F.lit("")).try_cast("bigint")


def first_decimal(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, FIRST_DECIMAL, 0), F.lit("")).try_cast("decimal(18,2)")


def more_follows(text: Column) -> Column:
    return F.when(text.rlike(MORE_FOLLOWS), 1).otherwise(0)


def continues(text: Column) -> Column:
    return F.when(text.rlike(CONTINUES), 1).otherwise(0)


def drop_leading_dots(text: Column) -> Column:
    return strip(F.regexp_replace(text, CONTINUES, ""))


def drop_trailing_dots(text: Column) -> Column:
    return strip(F.regexp_replace(text, MORE_FOLLOWS, ""))


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML entities to characters."""
    return text.map(html.unescape, na_action="ignore")


def url_pattern(domains: Sequence[str] = DOMAINS) -> str:
    """The published "liberal" URL pattern: addresses with a scheme, or bare domains with a known ending.

    Fixed but for the endings; brackets inside an address must balance.
    """
    known = "|".join(domains)
    nested = r"\([^\s()]*?\([^\s()]+\)[^\s()]*?\)"
    flat = r"\([^\s]+?\)"
    start = rf"(?:https?:(?:/{{1,3}}|[a-z0-9%])|[a-z0-9.\-]+[.](?:{known})/)"
    middle = rf"(?:[^\s()<>{{}}\[\]]+|{nested}|{flat})+"
    end = rf"(?:{nested}|{flat}|[^\s`!()\[\]{{}};:'\".,<>?«»“”‘’])"
    bare = rf"(?<!@)[a-z0-9]+(?:[.\-][a-z0-9]+)*[.](?:{known})\b/?(?!@)"
    return rf"(?iU)\b(?:{start}{middle}{end}|{bare})"


def _once(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use(text)`` with ``text`` evaluated once, however often ``use`` mentions it."""
    return F.transform(F.array(text), use)[0]


def remove_urls(text: Column, domains: Sequence[str] = DOMAINS) -> Column:
    """Text without web addresses. Texts that cannot hold one skip the long pattern."""
    pattern = url_pattern(domains)

    def replaced(t: Column) -> Column:
        return F.when(t.rlike(r"(?i)http|\.\p{L}"), F.regexp_replace(t, pattern, "")).otherwise(t)

    return _once(text, replaced)


def _remove(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return text


def _real_quotes(text: Column) -> Column:
    """Turn well-formed curly quotes straight, which the fixed patterns above do not reach."""
    text = F.regexp_replace(text, "[‘’]", "'")
    return F.regexp_replace(text, "[“”]", '"')


def _clean_marks(text: Column, domains: Sequence[str]) -> Column:
    """The part that tweets and claims share."""
    text = F.replace(text, F.lit(MANGLED_EM_DASH), F.lit(""))
    text = F.translate(text, "\n\t", "")
    text = remove_urls(_remove(text, BRACKETED, HASHTAG, HANDLE, DASHES), domains)
    return strip(F.regexp_replace(text, f"{MANGLED_SINGLE_QUOTES}|{MANGLED_DOUBLE_QUOTES}", "'"))


def clean_tweet(text: Column, domains: Sequence[str] = DOMAINS, fix_unicode: bool = False) -> Column:
    """Cleaned tweet text, NULL when nothing is left."""
    text = unescape(text)
    text = _real_quotes(text) if fix_unicode else text
    return _once(_clean_marks(text, domains), lambda t: F.when(t != "", t))


def clean_claim(text: Column, domains: Sequence[str] = DOMAINS, fix_unicode: bool = False) -> Column:
    """Cleaned claim text; the first and last characters, its quotation marks, are dropped."""
    text = F.replace(strip(text), F.lit("\u00a0"), F.lit(" "))
    text = F.regexp_replace(text, r"(?s)\A.|.\z", "")
    text = _real_quotes(text) if fix_unicode else text
    return _clean_marks(text, domains)


def clean_transcript(text: Column, fix_unicode: bool = False) -> Column:
    """Cleaned transcript text; line breaks and web addresses stay."""
    text = F.replace(strip(text), F.lit("\u00a0"), F.lit(" "))
    text = _real_quotes(text) if fix_unicode else text
    text = F.replace(text, F.lit(MANGLED_EM_DASH), F.lit(""))
    text = _remove(F.replace(text, F.lit('"'), F.lit("")), BRACKETED)
    text = F.regexp_replace(text, MANGLED_SINGLE_QUOTES, "'")
    text = F.regexp_replace(text, MANGLED_DOUBLE_QUOTES, '"')
    return strip(_remove(text, BRACKETED, HASHTAG, HANDLE, DASHES))
