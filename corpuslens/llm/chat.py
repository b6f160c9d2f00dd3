"""Chat formatting: every assistant turn becomes its own example behind all turns before it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", " </s>\n"
# fixed values: control strings of common chat templates, this one's marks among them
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
_ANY = "|".join(re.escape(c) for c in CONTROL)
_ESCAPE, _UNESCAPE = re.compile(rf"(\\*)({_ANY})"), re.compile(rf"\\(\\*)({_ANY})")
_TURN = re.compile(rf"(?<!\\){re.escape(OPEN)}((?:[^\\\n]|\\.)*)\n(.*?) (?<!\\){re.escape('</s>')}\n", re.S)

EXAMPLE_SCHEMA = "conv_id long, example int, turns int, text string, loss_start long, loss_end long"
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    """One more backslash before every control string, so that none of them stands bare."""
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def parse(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted example."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        yield unescape_role(m[1]), unescape(m[2])
        at = m.end()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``size`` characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 100 + sum(len(x) for x in row if isinstance(x, str))
        if chars >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


_EXAMPLE = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("turns", pa.int32()), ("text", pa.string()),
                      ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _expand(rows: Iterator[dict], trained: str) -> Iterator[tuple]:
    key, text, turns, example, open_end = object(), "", 0, 0, False
    for row in rows:
        if row["conv_id"] != key:
            if open_end:
                yield key, example, turns, text, len(text), len(text)
            key, text, turns, example = row["conv_id"], "", 0, 0
        role = row["role"] or ""
        body = escape(row["text"] or "")
        start = len(text) + len(OPEN) + len(escape_role(role)) + 1
        text = f"{text}{OPEN}{escape_role(role)}\n{body}{CLOSE}"
        turns += 1
        open_end = role != trained
        if not open_end:
            yield key, example, turns, text, start, start + len(body)
            example += 1
    if open_end:
        yield key, example, turns, text, len(text), len(text)


def prefix_examples(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per assistant turn: all turns up to it in one text, only its reply under the loss mask.

    Turns follow in order of turn (then role and text, which settles ties and repeated rows; a null turn is first). A
    null role or text reads as empty, a null conv_id as a conversation of its own. A conversation that doesn't end
    on an assistant turn has one more example with an empty mask, so that no turn is lost. Control strings inside texts
    and roles are escaped with a backslash, and ``parse`` undoes it. loss_start and loss_end are code points of ``text``.

    A conversation's rows are sorted into one task and streamed: it holds the running text alone. The
    expansion itself grows with the square of a conversation's turns, as the method has it.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(lambda it: _batches(_expand(_rows(it), trained), _EXAMPLE), EXAMPLE_SCHEMA)


def _digest(rows: Iterator[dict]) -> Iterator[tuple]:
    def out(key, last, loss, chars, formatted):
        turns, n = hashlib.sha256(), 0
        for role, text in parse(last):
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            n += 1
        return key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

    key, last, loss, chars, formatted = object(), None, hashlib.sha256(), 0, 0
    for row in rows:
        if row["conv_id"] != key:
            if last is not None:
                yield out(key, last, loss, chars, formatted)
            key, loss, chars, formatted = row["conv_id"], hashlib.sha256(), 0, 0
        last = row["text"]
        trained = unescape(last[row["loss_start"]:row["loss_end"]])
        loss.update(trained.encode("utf-8", "surrogatepass"))
        chars += len(trained)
        formatted += len(last)
    if last is not None:
        yield out(key, last, loss, chars, formatted)


def digests(examples: DataFrame) -> DataFrame:
    """What the examples hold, read back from their texts and masks alone: one row per conversation.

    ``examples`` come straight from ``prefix_examples`` (a conversation's rows together and in order); frames read from storage
    are first dealt and sorted again.
    """
    return examples.mapInArrow(lambda it: _batches(_digest(_rows(it)), _DIGEST), DIGEST_SCHEMA)
