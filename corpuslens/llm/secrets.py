"""Secret scans: base patterns, and weak candidates that count only beside complementary parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.spans import matches, overlapping

# fixed values: the three base kinds. The lengths that ACCESS and HEX ask for are in the pattern: a run that is too short
# holds no longer match, so the leftmost matches are the same as those of the bare runs less the short ones
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

# weak parts of a credential, reported only when linked
IDENTIFIER = (
    r"""(?i)(?:client|account|app|application|tenant|project|access_?key|user|login)[_-]?(?:id|name)?["']?\x20*[:=]"""
    r"""\x20*["']?[A-Za-z0-9._@-]{3,}""")
KEY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = (
    r"""(?i)(?:https?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|amqps?|s3|sftp|ftp|ldaps?|jdbc:[a-z]+)://"""
    r"""[^\x00-\x20"'<>]+|(?:host|hostname|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:-]{3,}""")

KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "identifier": "id", "endpoint": "place"}

_SPAN = "array<struct<start:bigint,rank:int,stop:bigint>>"


def _spans(text: Column, kind: str, pattern: str, gate: Column, keep) -> Column:
    found = matches(text, F.lit(pattern))
    found = found if keep is None else F.filter(found, keep)
    rank = F.lit(KINDS.index(kind))
    spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["stop"].alias("stop")))
    return F.when(gate, spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _near(spans: Column, others: Column, scope: int) -> Column:
    """Those of ``spans`` with one of ``others`` within ``scope`` on either side: an interval join by sorted ends."""
    return F.array_compact(F.zip_with(spans, overlapping(spans, others, scope), lambda s, n: F.when(n > 0, s)))


def _outside(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``."""
    return F.array_compact(F.zip_with(spans, overlapping(spans, others), lambda s, n: F.when(n == 0, s)))


def _if_any(spans: Column, work: Column) -> Column:
    return F.when(F.size(spans) > 0, work).otherwise(spans)


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))))


def scan(docs: DataFrame, text: str = "text", scope: int = 300, prefix: str = "") -> DataFrame:
    """``docs`` with ``{prefix}base`` and ``{prefix}linked``: spans (start, rank of KINDS, stop) in code points, sorted.

    Base spans are the leftmost non-overlapping matches of each kind that are long enough. Weak parts (identifiers,
    unlabelled keys, endpoints) that overlap no base span are joined by interval with the parts of other roles in the
    same text: a weak key is linked if an identifier or endpoint lies within ``scope`` code points, an
    identifier or endpoint if a base secret or a linked key does. A part alone is not reported.

    All in column expressions, one pass per pattern over texts that its gate lets through; nothing is shuffled. A null
    text is empty and has no spans. Every row is scanned on its own, so repeated rows give equal spans.
    """
    taken, work = {c.lower() for c in docs.columns}, "__scan_"
    while any(c.startswith(work) for c in taken):  # what is worked out on the way stands under names of its own
        work += "_"
    base_name, linked_name = f"{prefix}base", f"{prefix}linked"
    if {base_name.lower(), linked_name.lower()} & taken:
        raise ValueError(f"{base_name} or {linked_name} is a column already; give another prefix")

    def at(name: str) -> Column:
        return F.col(f"{work}{name}")

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({f"{work}{n}": c for n, c in {
        "whole": whole, "has_assign": whole.rlike(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
        "has_access": whole.contains("AKIA"), "has_hex": whole.rlike(r"[0-9a-f]{24}"),
        "has_parts": whole.contains("=") | whole.contains(":")}.items()})
    text_of = at("whole")
    base = {
        "assign": _spans(text_of, "assign", ASSIGN, at("has_assign"),
                         lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= 6),
        "access": _spans(text_of, "access", ACCESS, at("has_access"), None),
        "hex": _spans(text_of, "hex", HEX, at("has_hex"), None),
    }

    def add(rows: DataFrame, **fields: Column) -> DataFrame:
        return rows.withColumns({f"{work}{n}": c.cast(_SPAN) for n, c in fields.items()})

    rows = add(rows, base=F.array_sort(F.concat(*base.values())))
    strong = at("base")

    def of(role: str) -> Column:
        ranks = [KINDS.index(k) for k in ("assign", "access", "hex") if ROLE[k] == role]
        return F.filter(strong, lambda s: reduce(lambda a, b: a | b, [s["rank"] == r for r in ranks]))

    # a lone weak part can't be linked: without a secret or place beside it the other patterns needn't run. Identifiers and
    # endpoints hold a mark of has_parts, a key doesn't: an access id alone links it
    parts = at("has_parts") & ((F.size(strong) > 0) | text_of.rlike(r"[A-Za-z0-9+/_-]{20}"))
    key_parts = parts | (F.size(of("id")) > 0)
    rows = add(
        rows, identifier=_spans(text_of, "identifier", IDENTIFIER, parts, None),
        key=_spans(text_of, "key", KEY, key_parts, lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]")),
        endpoint=_spans(text_of, "endpoint", ENDPOINT, parts, None))
    rows = add(rows, **{f"free_{n}": _if_any(at(n), _outside(at(n), strong)) for n in ("identifier", "key", "endpoint")})
    ids, keys, places = at("free_identifier"), at("free_key"), at("free_endpoint")
    rows = add(rows, lone_key=_if_any(keys, _outside(keys, places)))
    rows = add(rows, keys=_if_any(at("lone_key"), _near(at("lone_key"), F.concat(of("id"), ids, places), scope)))
    secrets, others = F.concat(of("secret"), at("keys")), F.concat(ids, places)
    rows = add(rows, linked=F.array_sort(F.concat(at("keys"), _if_any(others, _near(others, secrets, scope)))))
    done = rows.withColumns({base_name: strong, linked_name: at("linked")})
    return done.drop(*[c for c in done.columns if c.startswith(work)])


def report(docs: DataFrame, scope: int = 300) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per input row."""
    found = scan(docs.select("doc_id", "text"), scope=scope)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.array_sort(F.concat("base", "linked"))).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = 300) -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark`` and n_chars, where there is one, counted again.

    Overlapping spans become one mark. Texts without spans, null ones too, stay as they are.
    """
    prefix = "__"
    while any(c.lower() in (f"{prefix}base", f"{prefix}linked", f"{prefix}text") for c in docs.columns):
        prefix += "_"
    found = scan(docs, scope=scope, prefix=prefix)
    text, spans = F.col("text"), F.array_sort(F.concat(f"{prefix}base", f"{prefix}linked"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def add(done, s):
        inside = s["start"] < done["at"]
        gap = F.when(inside, F.lit("")).otherwise(
            F.concat(F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark)))
        return F.struct(F.greatest(done["at"], s["stop"]).alias("at"), F.concat(done["out"], gap).alias("out"))

    clean = F.aggregate(spans, start, add, lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.length(text) - done["at"])))
    out = found.withColumn(f"{prefix}text", F.when(F.size(spans) > 0, clean).otherwise(text))
    changed = {"text": F.col(f"{prefix}text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(spans) > 0, F.length(f"{prefix}text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
