"""License scans: ordered signature rules behind keyword gates, overlaps settled by priority and containment."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.spans import count_words, let, matches, overlapping

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # between words of the text before A-Z is lower-cased
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: base phrases and labels
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


class Rule(NamedTuple):
    label: str
    keywords: str  # parted by |, one of which must occur
    pattern: str
    trust: float


# label, words of the name as a pattern, words of which one must occur, versions (as words)
FAMILIES = (
    ("apache", "apache(?: software)?", "apache", ("1 0", "1 1", "2 0", "2")),
    ("mit", "mit", " mit ", ()),
    ("mit-0", "mit no attribution", "attribution", ()),
    ("bsd-2-clause", "(?:2|two) clause bsd|bsd 2 clause|simplified bsd|freebsd", "bsd", ()),
    ("bsd-3-clause", "(?:3|three) clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd", "bsd", ()),
    ("bsd-4-clause", "(?:4|four) clause bsd|bsd 4 clause|original bsd", "bsd", ()),
    ("bsd", "bsd", " bsd ", ()),
    ("gpl", "(?:gnu )?general public|gnu gpl|gpl", "gpl|general public", ("1", "1 0", "2", "2 0", "3", "3 0")),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public|(?:gnu )?lgpl", "lgpl|lesser general|library general", ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", "(?:gnu )?affero general public|(?:gnu )?agpl", "agpl|affero", ("1", "3", "3 0")),
    ("gfdl", "(?:gnu )?free documentation|gfdl", "gfdl|free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public|mpl", " mpl|mozilla", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public|epl", " epl|eclipse", ("1 0", "2 0")),
    ("edl", "eclipse distribution", "eclipse", ("1 0",)),
    ("cddl", "common development and distribution|cddl", "cddl|common development", ("1 0", "1 1")),
    ("cpl", "common public", "common public", ("1 0",)),
    ("cpal", "common public attribution|cpal", "cpal|common public attribution", ("1 0",)),
    ("eupl", "european union public|eupl", "eupl|european union", ("1 0", "1 1", "1 2")),
    ("isc", "isc", " isc ", ()),
    ("zlib", "zlib", "zlib", ()),
    ("boost", "boost software|boost", "boost", ("1 0",)),
    ("artistic", "artistic|clarified artistic", "artistic", ("1 0", "2 0")),
    ("python", "python software foundation|psf", "psf|python software", ("2", "2 0")),
    ("php", "php", " php ", ("3 0", "3 01")),
    ("ruby", "ruby", "ruby", ()),
    ("openssl", "openssl", "openssl", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("microsoft-public", "microsoft public|ms pl", "ms pl|microsoft public", ()),
    ("microsoft-reciprocal", "microsoft reciprocal|ms rl", "ms rl|microsoft reciprocal", ()),
    ("ofl", "(?:sil )?open font|ofl", " ofl|open font", ("1 0", "1 1")),
    ("odbl", "open database|odbl", "odbl|open database", ("1 0",)),
    ("odc-by", "open data commons attribution|odc by", "odc by|open data commons", ("1 0",)),
    ("pddl", "(?:open data commons )?public domain dedication|pddl", "pddl|domain dedication", ("1 0",)),
    ("cecill", "cecill", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("osl", "open software|osl", " osl|open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free|afl", " afl|academic free", ("1 2", "2 0", "2 1", "3 0")),
    ("upl", "universal permissive|upl", " upl|universal permissive", ("1 0",)),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa", ()),
    ("wtfpl", "wtfpl|do what the fuck you want to public", "wtfpl|do what the fuck", ("2",)),
    ("beerware", "beer ?ware", "beerware|beer ware", ("42",)),
    ("unlicense", "unlicense", "unlicense", ()),
    ("bsl", "business source|busl", "busl|business source", ("1 1",)),
    ("sspl", "server side public|sspl", "sspl|server side", ("1", "1 0")),
    ("elastic", "elastic", "elastic", ("2", "2 0")),
    ("openrail", "(?:creativeml )?openrail(?: m)?", "openrail", ("1",)),
    ("ogl", "open government|ogl", " ogl|open government", ("1 0", "2 0", "3 0")),
    ("w3c", "w3c(?: software)?", "w3c", ()),
    ("x11", "x11", "x11", ()),
)
# names that are words or short forms of other things too: beside a version they need a grant or the word licence
AMBIGUOUS = frozenset(
    "mit mit-0 isc boost artistic python php ruby openssl epl edl cpl cpal afl upl osl ofl ogl elastic w3c x11 zlib bsl ncsa unlicense "
    "beerware postgresql".split())
CC_KINDS = ("by nc sa", "by nc nd", "by nc", "by sa", "by nd", "by")
CC_NAMES = {
    "by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?derivatives?",
    "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?derivatives?"}
CC_VERSIONS = ("4 0", "3 0", "2 5", "2 0", "1 0")
NOTICES = (
    ("reserved", "reserved", "(?:all|some|no) rights reserved", 0.6),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])*", 0.5),
    ("copyright", "copyright", "copyright(?: c)?", 0.3),
    ("copyleft", "copyleft", "copyleft", 0.4),
    ("public-domain", "domain", "(?:dedicated to|released (?:in)?to|placed in(?:to)?|in) the public domain", 0.8),
    ("public-domain", "domain", "public domain", 0.4),
    ("warranty", "warranty", "(?:provided )?as is without (?:any )?warranty(?: of any kind)?", 0.6),
    ("warranty", "warranties", "without warranties or conditions of any kind", 0.6),
    ("permission", "permission", "permission is hereby granted free of charge to any person", 0.9),
    ("permission", "permission", "permission to use copy modify and or distribute", 0.9),
    ("redistribution", "redistribution", "redistribution and use in source and binary forms", 0.9),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary", 0.7),
    ("no-derivatives", "reproduced|copied|distributed", "may not be (?:reproduced|copied|distributed)", 0.5),
    ("licensed", "licensed", "(?:is |are )?(?:dual )?licensed under", 0.3),
    ("licensed", "licence", "see (?:the )?licence(?: file)?(?: for details)?", 0.3),
    ("licensed", "license", "see (?:the )?license(?: file)?(?: for details)?", 0.3),
)


def _rules() -> list[Rule]:
    """Signatures in order of priority: exact versions, whole names, short names, notices."""
    given = r"(?:licensed|released|distributed|available|published|provided|shared|covered)(?: \S+){0,3} under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
    first, second, third = [], [], []
    for kind in CC_KINDS:
        label = "cc-" + kind.replace(" ", "-")
        for v in CC_VERSIONS:
            number = v.replace(" ", ".")
            first += [
                Rule(f"{label}-{number}", f" cc {kind} {v} ", rf"(?:{given})?(?:creative commons )?cc {kind} {v}", 1.0),
                Rule(f"{label}-{number}", "creative commons", rf"(?:{given})?creative commons {CC_NAMES[kind]} {v}(?: (?:international|unported|generic))?(?: licen[sc]e)?", 1.0)]
        second += [
            Rule(label, f" cc {kind} ", rf"(?:{given})?cc {kind}", 0.8),
            Rule(label, "creative commons", rf"(?:{given})?creative commons {CC_NAMES[kind]}(?: licen[sc]e)?", 0.8)]
    first += [Rule("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 1.0), Rule("cc0-1.0", "commons zero", r"creative commons zero(?: v?1 0)?", 1.0)]
    for label, name, word, versions in FAMILIES:
        for v in versions:
            number = v.replace(" ", ".") + ("" if " " in v else ".0")
            after = rf"(?: as published by the free software foundation)?(?: either)? (?:v|version |v )?{v}"
            later = r"(?: (?:or (?:any|at your option any)? ?later|only))?"
            sure = rf"{given}(?:{name})(?: public)?(?: licen[sc]e)?{after}|(?:{name})(?: public)? licen[sc]e{after}|(?:{name})(?: public)? (?:v|version |v )?{v} licen[sc]e"
            plain = rf"(?:{given})?(?:{name})(?: public)?(?: licen[sc]e)?{after}"
            first.append(Rule(f"{label}-{number}", word, f"(?:{sure if label in AMBIGUOUS else plain}){later}", 1.0))
        first.append(Rule(label, "spdx", rf"spdx license identifier (?:{name})(?: [0-9][0-9a-z]*)*(?: or later| only)?", 1.0))
        second.append(Rule(label, word, rf"{given}(?:{name})(?: public)?(?: licen[sc]e)?", 0.9))
        third.append(Rule(label, word, rf"(?:the )?(?:{name}) licen[sc]e", 0.7))
    notices = [Rule(label, word, pattern, trust) for label, word, pattern, trust in NOTICES]
    return [*first, *second, *third, *notices]


RULES = _rules()


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(norm: Column, pattern: Column) -> Column:
    """Matches by word: start, stop. ``norm`` has one space before, between and after its words."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    return F.transform(matches(norm, whole, _spaces), lambda m: F.struct(
        (m["start"] - 1).alias("start"), m["stop"].alias("stop")))


_FOUND = "array<struct<start:bigint,last:bigint,rank:int,stop:bigint>>"


def _keywords(norm: Column) -> Column:
    """The rules' keywords that occur in a text."""
    words = sorted({w for r in RULES for w in r.keywords.split("|")})
    return F.filter(F.expr(f"array({','.join(map(repr, words))})"), lambda k: F.contains(norm, k))


def _detections(norm: Column, here: Column) -> Column:
    """All matches of all rules with a keyword in ``here``, sorted by start, longest first, then priority."""
    rules = F.expr("array(" + ",".join(
        f"struct({k} as rank, array({','.join(map(repr, r.keywords.split('|')))}) as keywords, r'{r.pattern}' as pattern)"
        for k, r in enumerate(RULES)) + ")")
    near = F.filter(rules, lambda r: F.arrays_overlap(r["keywords"], here))
    found = F.flatten(F.transform(near, lambda r: F.transform(_places(norm, r["pattern"]), lambda p: F.struct(
        p["start"].alias("start"), (-p["stop"]).alias("last"), r["rank"].alias("rank"), p["stop"].alias("stop")))))
    return F.array_sort(found)


def _settled(found: Column) -> Column:
    """The detections that stay: by priority, of one rule the longest first, each that overlaps none that stays already.

    A detection inside another or across its edge thus goes only if the other stays. Detections that overlap none at all
    are passed by; the others are taken one after the other.
    """
    none = F.array().cast(_FOUND)

    def place(d, *names):
        return F.struct(*[d[n].alias(n) for n in names])

    def greedy(crowd):
        ordered = F.array_sort(F.transform(crowd, lambda d: place(d, "rank", "last", "start", "stop")))

        def add(kept, d):
            meets = F.exists(kept, lambda k: (k["start"] < d["stop"]) & (k["stop"] > d["start"]))
            return F.when(meets, kept).otherwise(F.concat(kept, F.array(place(d, "start", "last", "rank", "stop"))))

        return F.aggregate(ordered, none, add)

    def settled(pairs):
        alone = F.filter(pairs, lambda p: p["n"] == 1)
        crowd = F.filter(pairs, lambda p: p["n"] > 1)
        return F.array_sort(F.concat(F.transform(alone, lambda p: p["d"]), greedy(F.transform(crowd, lambda p: p["d"]))))

    return let(found, lambda ds: let(
        F.zip_with(ds, overlapping(ds, ds), lambda d, n: F.struct(d.alias("d"), n.alias("n"))), settled))


def scan(docs: DataFrame) -> DataFrame:
    """Base counts and labels, and the labels and trust of the settled detections: one row per input row.

    Base places are those where a phrase's words stand consecutively; they and their labels stay
    whatever the rules say. Every text is normalised; each rule runs only where
    its keyword occurs, on the lower-cased words of the whole text. ``score`` is the
    highest trust of a detection that stays (0 without one).

    Column expressions only, nothing is shuffled. A null text is empty: no words, empty labels. Repeated rows give
    equal results; only doc_id and text are read.
    """
    text = F.coalesce("text", F.lit(""))
    norm = F.concat(F.lit(" "), F.regexp_replace(F.translate(text, UPPER, LOWER), BREAK, " "), F.lit(" "))
    rows = docs.select(
        "doc_id", count_words(text, GAP).alias("n_words"), F.regexp_replace(norm, " {2,}", " ").alias("norm"))
    # a base phrase can't overlap itself, so its matches are all its places
    base = {label: _places(F.col("norm"), F.lit(phrase)) for phrase, label in BASE}
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    found = rows.withColumns(
        {f"base{k}": F.when(F.col("norm").contains(f" {phrase} "), base[label]).otherwise(none)
         for k, (phrase, label) in enumerate(BASE)}
    ).withColumn("here", _keywords(F.col("norm")))
    found = found.withColumn("kept", F.when(
        F.size("here") > 0, _settled(_detections(F.col("norm"), F.col("here")))).otherwise(F.array().cast(_FOUND)))
    starts = F.transform(F.concat(*[f"base{k}" for k in range(len(BASE))]), lambda p: p["start"])
    plain = F.array_compact(F.array(*[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    labels = F.expr(f"array({','.join(repr(r.label) for r in RULES)})")
    trust = F.expr(f"array({','.join(f'{r.trust}D' for r in RULES)})")
    return found.withColumns({"starts": starts, "plain": plain}).select(
        "doc_id", "n_words", F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.concat_ws(",", F.array_sort("plain")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(
            "plain", F.transform("kept", lambda d: F.element_at(labels, d["rank"] + 1)))))).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: F.element_at(trust, d["rank"] + 1))), F.lit(0.0)).alias("score"))
