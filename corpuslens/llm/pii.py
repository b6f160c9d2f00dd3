"""Personal data: patterns, gazetteers and contexts vote on candidate spans; what they are worth is learned without labels."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import stored
from corpuslens.llm.spans import let, matches, overlapping

# The four base kinds. Loops are possessive where that changes no match, so that long runs are read once; a match may begin at the
# end of the one before (\G) or where its run of characters begins
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# kinds that the method adds
GROUPED = r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
MAIL = r"(?i)[a-z0-9._%+-]{1,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[a-z0-9-]{1,63}(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[a-z0-9-]{1,63}){1,8}"
TEL = r"(?<![0-9+(.]|\+[0-9]{1,3}[\x20-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?!\.?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
MAC = r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:-])"
IPV6 = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
PERSON = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\.?\x20|[Nn]ame is\x20|[Nn]ame:\x20?)\p{Lu}\p{L}{1,30}(?:\x20\p{Lu}\p{L}{1,30}){0,2}"
STREET = r"(?<![0-9A-Za-z])[0-9]{1,5}\x20\p{Lu}\p{L}{1,30}(?:\x20\p{Lu}\p{L}{1,30})?\x20(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd)\b"

KINDS = ("email", "ip", "card", "phone", "grouped", "mail", "tel", "ssn", "iban", "mac", "ipv6", "person", "street")
BASE = KINDS[:4]
LABELERS = ("form", "gazetteer", "cue", "other_cue", "edges", "company")
PRIOR = (0.75, 0.7, 0.75, 0.9, 0.9, 0.6)  # how often each is taken to be right before anything is learned

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_COUNTRIES = "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT KW KZ LB LI LT LU LV MC MD ME MK MT MU NL NO PL PS PT QA RO RS SA SE SI SK SM TN TR UA VG XK"
_NAMES = "Anna|Ana|Anne|Carlos|David|Emma|Hans|James|Jean|Jan|John|Jose|José|Juan|Julia|Karl|Laura|Luis|Maria|María|Marie|Mark|Mary|Michael|Paul|Peter|Pierre|Robert|Sarah|Sofia|Thomas|William"

# what a pattern says of the hit itself: (for, against) per kind
_FORM = {
    "email": (r"^[A-Za-z0-9][^@]*@.*\.[A-Za-z]{2,24}$", r"\.\.|^\.|\.@|\.[0-9]+$"),
    "ip": (r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$", r"(?:^|\.)0[0-9]"),
    "card": (r"^(?:[0-9]{16}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$", r"^([0-9])(?:[\x20-]?\1)+$"),
    "phone": (r"^\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}$", r"\.\.|--|\x20\x20|\)\)"),
    "mail": (r"(?i)[\])}]\x20?[a-z]{2,24}$|\.[a-z]{2,24}$", r"[0-9]$"),
    "tel": (r"^(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20-])[0-9]{3}[\x20-][0-9]{4}$", r"^[0-9]{2,4}\.[0-9]{3}\.[0-9]{3}$"),
    "ssn": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$", r"^(?:000|666|9)|-00-|-0000$"),
    "mac": (r"^[0-9A-Fa-f]{2}:|^[0-9A-F]{2}-", r"^(?:00[:-]){5}00$|^(?:ff[:-]){5}ff$"),
    "ipv6": (r"^[23][0-9A-Fa-f]{3}:|^f[de]", r"^(?:0{1,4}:){7}"),
    "person": (r"\p{Lu}\p{L}+\x20\p{Lu}\p{L}+$", r"\p{Lu}{3}"),
    "street": (r"^[1-9][0-9]{0,4}\x20", r"^0"),
}
# fixed lists: (known names, known placeholders) per kind
_GAZETTEER = {
    "email": (r"(?i)\.(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info|it|nl|ch)$", r"(?i)@(?:test|localhost|invalid)\.|^(?:noreply|no-reply|example)@"),
    "ip": (r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.", r"^(?:0+|127|255)\.|\.0+\.0+$"),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[4578]|6(?:011|5)|35|62)", r"^(?:0|1|7|8|9)"),
    "phone": (r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", r"^\+0|1234567|0000000"),
    "mail": (r"(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu)$", r"(?i)^(?:someone|user|name)\x20?[\[({]"),
    "tel": (r"^\(?[2-9][0-9]{2}", r"^\(?[01]|0000$|1234$"),
    "ssn": (r"^[0-7]", r"^(?:123-45-6789|078-05-1120|219-09-9999)$"),
    "iban": (rf"^(?:{_COUNTRIES.replace(' ', '|')})", r"0000000000"),
    "mac": (r"^[0-9A-Fa-f][048cC26aAeE]", r"(?i)^(?:de:ad|00:11:22)"),
    "ipv6": (r"^2", r"(?i)^2001:0?db8"),
    "person": (rf"\b(?:{_NAMES})\b", r"\b(?:Who|President|Smithson)\b"),
    "street": (r"(?:Street|Avenue|Road|Lane|Boulevard)$", r"^(?:1|123)\x20(?:Main|Any)\x20"),
}
_FORM["grouped"], _GAZETTEER["grouped"] = _FORM["card"], _GAZETTEER["card"]
# words before a hit: those of its kind, and those of other numbers
_CUE = {
    "email": r"mail|contact|write|correo|courriel|kontakt|from:|to:|cc:", "ip": r"\bip\b|address|addr|host|server|client|peer|from|login",
    "card": r"card|visa|master|amex|carte|tarjeta|karte|payment|credit|debit", "phone": r"phone|tel|call|mobil|cell|fax|whatsapp|ruf",
    "ssn": r"ssn|social|security|taxpayer|insured", "iban": r"iban|account|konto|compte|cuenta|bank", "mac": r"mac|ether|device|adapter|hw",
    "ipv6": r"ip|address|host|server|inet", "person": r"contact|patient|dear|signed|attn|sincerely|born", "street": r"address|live|located|at|ship|home",
}
_CUE |= {"grouped": _CUE["card"], "mail": _CUE["email"], "tel": _CUE["phone"]}
_OTHER_CUE = (r"(?i)(?:\bv|version|release|build|isbn|issn|doi|order|invoice|sku|serial|ticket|chapter|section|page|figure|table|total|price|"
              r"amount|[$€£#§])[^\p{L}0-9]{0,3}$")

_FOUND = "array<struct<rank:int,start:bigint,stop:bigint,base:boolean,form:int,gazetteer:int,cue:int,other_cue:int,edges:int,company:int>>"


def _digits(hit: Column) -> Column:
    return F.translate(hit, " -().+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def total(back):
        def add(done, i):
            d = F.substring(back, i, 1).cast("int")
            twice = F.substring(F.lit("0246813579"), d + 1, F.lit(1)).cast("int")
            return done + F.when(i % 2 == 1, d).otherwise(twice)

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)

    return let(F.reverse(digits), total) % 10 == 0


def _iban_sum(hit: Column) -> Column:
    """Whether the check digits fit: letters read as 10 to 35, the first four characters last, modulo 97."""
    plain = F.translate(hit, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def add(rest, c):
        n = F.instr(F.lit(letters), c)
        return F.when(n > 0, (rest * 100 + 9 + n) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _votes(kind: str, m: Column) -> list[Column]:
    """What every labeler but the last says: 1 for personal data, -1 against, 0 nothing."""
    hit = m["hit"]
    if kind == "iban":
        form = _vote(_iban_sum(hit), ~_iban_sum(hit))
    else:
        form = _vote(hit.rlike(_FORM[kind][0]), hit.rlike(_FORM[kind][1]))
    if kind == "grouped":
        form = _vote(luhn(_digits(hit)), ~luhn(_digits(hit)))
    gazetteer = _vote(hit.rlike(_GAZETTEER[kind][0]), hit.rlike(_GAZETTEER[kind][1]))
    cue = F.when(m["before"].rlike(f"(?i)(?:{_CUE[kind]})"), 1).otherwise(0)
    other = F.when(m["before"].rlike(_OTHER_CUE), -1).otherwise(0)
    glued = m["before"].rlike(r"[\p{L}0-9_=/]$") | m["after"].rlike(r"^[\p{L}0-9_=/]")
    return [form, gazetteer, cue, other, F.when(glued, -1).otherwise(0)]


def _spans(text: Column, kind: str, pattern: str, gate: Column, base=None, shift: Column | None = None) -> Column:
    """Candidates of a kind as ``_FOUND``; ``base`` marks the base ones and drops the rest."""
    found = matches(text, F.lit(pattern), context=40)
    if base is not None:
        found = F.filter(found, base)
    rank, moved = KINDS.index(kind), F.lit(0) if shift is None else shift
    spans = F.transform(found, lambda m: F.struct(
        F.lit(rank), m["start"] + moved, m["stop"] + moved, F.lit(base is not None), *_votes(kind, m), F.lit(0)))
    return F.when(gate, spans.cast(_FOUND)).otherwise(F.array().cast(_FOUND))


def candidates(docs: DataFrame, text: str = "text", column: str = "found") -> DataFrame:
    """``docs`` with ``column``: every candidate span of the text with its labelers' votes, by kind and start.

    Base kinds are the leftmost non-overlapping matches that pass their checks. The other kinds are candidates only; those that
    overlap a base span are left out. Everything is a column expression over the whole text of one row; a null text is empty and
    has no candidates, repeated rows have equal ones. Places are code points, stop exclusive. Work grows with the
    length of a text and with its number of matches.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    digit = whole.rlike("[0-9]")

    def is_card(m):
        digits = _digits(m["hit"])
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)

    base = [
        _spans(whole, "email", EMAIL, whole.contains("@"), lambda m: F.lit(True)),
        _spans(whole, "ip", IP, whole.rlike(r"[0-9]\.[0-9]++\.[0-9]"), lambda m: m["hit"].rlike(_IP_PARTS)),
        _spans(whole, "card", CARD, whole.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), is_card),
        _spans(whole, "phone", PHONE, whole.rlike(r"\+[0-9]"), lambda m: F.length(_digits(m["hit"])).between(8, 15)),
    ]
    gates = {
        "grouped": (GROUPED, digit & whole.rlike(r"[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}")),
        "mail": (MAIL, whole.rlike(r"(?i)[\[({]\x20?at\x20?[\])}]")),
        "tel": (TEL, digit & whole.rlike(r"[0-9][)\x20.-]\x20?[0-9]{3,4}[\x20.-][0-9]{3}")),
        "ssn": (SSN, digit & whole.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")),
        "iban": (IBAN, digit & whole.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}\x20?[A-Z0-9]{4}")),
        "mac": (MAC, digit & whole.rlike(r"(?:[0-9A-Fa-f]{2}[:-]){5}")),
        "ipv6": (IPV6, whole.rlike(r"(?:[0-9A-Fa-f]{1,4}:){7}")),
        "person": (PERSON, whole.rlike(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\.?\x20\p{Lu}|[Nn]ame(?: is|:)\x20?\p{Lu}")),
        "street": (STREET, digit & whole.rlike(r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd)\b")),
    }
    extra = [_spans(whole, kind, pattern, gate) for kind, (pattern, gate) in gates.items()]
    first, second, third = (_free(docs, n) for n in ("base_found", "more_found", "all_found"))
    rows = docs.withColumn(first, F.concat(*base)).withColumn(second, F.concat(*extra))
    rows = rows.withColumn(third, F.concat(F.col(first), F.when(
        F.size(second) == 0, F.col(second)).otherwise(_outside(F.col(second), F.col(first)))))
    # the last labeler: personal data of another kind in the same text
    kinds = F.size(F.array_distinct(F.transform(third, lambda s: s["rank"])))
    company = let(F.when(kinds > 1, 1).otherwise(0), lambda n: F.transform(third, lambda s: s.withField("company", n)))
    done = rows.withColumn(third, F.array_sort(company.cast(_FOUND)))
    return done.select(*[F.col(c) for c in docs.columns], F.col(third).alias(column))


def _free(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores as make it none of the columns."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _outside(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``."""
    return F.array_compact(F.zip_with(spans, overlapping(spans, others), lambda s, n: F.when(n == 0, s)))


@dataclass
class Model:
    """Reliabilities by kind and labeler, and the weights of the final classifier."""

    reliability: dict[tuple[str, str], tuple[float, float]]
    bias: float
    weights: list[float]

    def score(self, span: Column) -> Column:
        total = reduce(lambda a, b: a + b, [w * f for w, f in zip(self.weights, _features(span), strict=True)], F.lit(self.bias))
        return 1 / (1 + F.exp(-total))


def _features(span) -> list[Column]:
    kinds = [(span["rank"] == r).cast("double") for r in range(len(KINDS))]
    votes = [(span[name] == v).cast("double") for name in LABELERS for v in (1, -1)]
    return kinds + votes


def aggregate_votes(patterns: list[tuple], rounds: int = 50, weight: float = 20.0) -> tuple[list[float], dict]:
    """Expectation-maximisation over (rank, votes, n): how likely each pattern is personal data, and what each labeler is worth.

    A labeler says yes, no or nothing, each with a probability that depends on the truth, per kind. All start from the
    majority vote; ``weight`` imagined votes of a labeler right ``PRIOR`` of the time keep rare kinds steady.
    """
    kinds = sorted({p[0] for p in patterns})
    belief = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes)) for _, votes, _ in patterns]
    table = {}
    for _ in range(rounds):
        share, table = {}, {}
        for kind in kinds:
            mine = [(votes, n, q) for (k, votes, n), q in zip(patterns, belief, strict=True) if k == kind]
            yes, every = sum(n * q for _, n, q in mine), sum(n for _, n, _ in mine)
            share[kind] = (yes + weight / 2) / (every + weight)
            for j, prior in enumerate(PRIOR):
                for truth in (0, 1):
                    counts = {-1: weight * 0.5 * (1 - prior if truth else prior), 1: weight * 0.5 * (prior if truth else 1 - prior), 0: weight * 0.5}
                    for votes, n, q in mine:
                        counts[votes[j]] += n * (q if truth else 1 - q)
                    total = sum(counts.values())
                    table[kind, j, truth] = {v: c / total for v, c in counts.items()}
        before, belief = belief, []
        for kind, votes, _ in patterns:
            odds = math.log(share[kind] / (1 - share[kind]))
            odds += sum(math.log(table[kind, j, 1][v] / table[kind, j, 0][v]) for j, v in enumerate(votes))
            belief.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        if max((abs(a - b) for a, b in zip(before, belief, strict=True)), default=0.0) < 1e-6:
            break
    return belief, {(KINDS[k], LABELERS[j]): (table[k, j, 1][1], table[k, j, 0][1]) for k in kinds for j in range(len(LABELERS)) if (k, j, 1) in table}


def fit(found: DataFrame, column: str = "found") -> Model:
    """Learn from all candidates of all documents.

    Votes are counted per pattern (at most 3^6 a kind, whatever the corpus); only these counts come to the driver for
    the rounds of expectation-maximisation. The classifier, a logistic regression on kind and votes, is then trained
    on the patterns, each once as personal data and once not, weighted by what the labelers believe. Without candidates the model scores one half.
    """
    spans = found.select(F.explode(column).alias("s")).select("s.rank", *[f"s.{n}" for n in LABELERS])
    counted = spans.groupBy("rank", *LABELERS).agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted((r["rank"], tuple(r[n] for n in LABELERS), r["n"]) for r in counted.collect())
    width = len(KINDS) + 2 * len(LABELERS)
    if not patterns:
        return Model({}, 0.0, [0.0] * width)
    belief, reliability = aggregate_votes(patterns)
    total = sum(n for *_, n in patterns)
    rows = [(kind, *votes, float(y), w * n / total) for (kind, votes, n), q in zip(patterns, belief, strict=True)
            for y, w in ((1, q), (0, 1 - q)) if w > 0]
    schema = f"rank int, {', '.join(f'{n} int' for n in LABELERS)}, label double, weight double"
    frame = found.sparkSession.createDataFrame(rows, schema).coalesce(1)
    frame = frame.select("label", "weight", array_to_vector(F.array(*_features({n: F.col(n) for n in ("rank", *LABELERS)}))).alias("features"))
    trained = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=50).fit(frame)
    return Model(reliability, float(trained.intercept), [float(w) for w in trained.coefficients])


def accepted(found: Column, model: Model, threshold: float = 0.6) -> Column:
    """Base spans and those others that the classifier takes for personal data."""
    return F.filter(found, lambda s: s["base"] | (model.score(s) >= threshold))


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added, score: one row per input row.

    ``added`` counts the spans that are not base ones and ``score`` is the largest of all (null without candidates). Texts are read
    once; candidates are kept in the shared folder, and both the learning and the result read them there.
    """
    found = stored(candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    model = fit(found)
    rows = found.withColumn("kept", accepted(F.col("found"), model, threshold))
    base = F.filter("kept", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("kept", lambda s: s["base"] & (s["rank"] == KINDS.index(kind)))).cast("bigint")

    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(_named(base), 256).alias("base_sha256"),
        _named(F.col("kept")).alias("spans"), (F.size("kept") - F.size(base)).cast("bigint").alias("added"),
        F.array_max(F.transform("found", lambda s: model.score(s))).alias("score"))
