"""Conversation structure repair: the cheapest edits, found in sorted streams over each conversation's turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\x0c\r"
LETTERS = "DIKR"  # edits in ASCII order: delete, insert, keep, rerole
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# states: which role came last. An accepted conversation is empty or s?(ua)+
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # the turn that may follow, as an insertion or a new role
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = "sua"
_MUST_GO, _CUT = 4, 8  # flags of a row's kind, beside the place of its role in _INITIALS (3: none of them)
_FAR = 1 << 30

Costs = tuple[int, int, int, int]
_END: Costs = (0, 2 * INSERT, INSERT, 0)


def _kept(state: int, initial: int) -> int | None:
    """The state behind a turn that keeps its role, None where the role can't stand."""
    if initial == 0:
        return _SYSTEM if state == _START else None
    return initial + 1 if initial < 3 and _NEXT[state] == initial + 1 else None


def _step(after: Costs, kind: int) -> tuple[Costs, int]:
    """Costs to the end before a row, less the smallest, and the first edit of each state: two bits a state, one byte a row."""
    initial, cut = kind & 3, TRUNCATED if kind & _CUT else 0
    ways = []
    for state in range(4):
        way = {"D": DELETE + after[state]}
        if not kind & _MUST_GO:
            kept = _kept(state, initial)
            if kept is not None:
                way["K"] = KEEP + cut + after[kept]
            way["R"] = REROLE + cut + after[_NEXT[state]]
        ways.append(way)
    best = [min(way.values()) for way in ways]
    for _ in range(3):  # an insertion leaves the row where it is
        best = [min(b, INSERT + best[_NEXT[s]]) for s, b in enumerate(best)]
    for state, way in enumerate(ways):
        way["I"] = INSERT + best[_NEXT[state]]
    byte = sum(LETTERS.index(min(x for x in way if way[x] == best[s])) << 2 * s for s, way in enumerate(ways))
    low = min(best)
    return tuple(b - low for b in best), byte


def _opens(conv: np.ndarray, absent: np.ndarray, last: tuple | None) -> np.ndarray:
    """Whether each row opens another conversation than the row before it."""
    out = np.ones(len(conv), bool)
    out[1:] = (conv[1:] != conv[:-1]) | (absent[1:] != absent[:-1])
    if len(out):
        out[0] = last != (conv[0], absent[0])
    return out


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds to each row the first edit of every state (``pointer``) and its place from the conversation's end (``back``)."""
    seen: dict[tuple[Costs, int], tuple[Costs, int]] = {}  # costs differ by a few insertions at most, so these are few
    last, costs, back = None, _END, 0
    for frame in frames:
        if not len(frame):
            continue
        opens = _opens(frame["conv"].to_numpy(), frame["no_conv"].to_numpy(), last)
        pointers, places = np.empty(len(frame), np.int16), np.empty(len(frame), np.int64)
        for i, (new, kind) in enumerate(zip(opens.tolist(), frame["kind"].tolist(), strict=True)):
            if new:
                costs, back = _END, 0
            key = (costs, kind)
            if key not in seen:
                seen[key] = _step(costs, kind)
            costs, pointers[i] = seen[key]
            places[i] = back
            back += 1
        last = (frame["conv"].iat[-1], frame["no_conv"].iat[-1])
        yield frame.assign(pointer=pointers, back=places)


_EDIT = "conv long, no_conv boolean, at long, edit string, turn long, no_turn boolean, role string, text string, old_role string, fault string"


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows the pointers from each conversation's first row: one row per edit."""
    last, state, at = None, _START, 0
    out: list[tuple] = []

    def close():
        nonlocal state, at
        while last is not None and state in (_SYSTEM, _USER):
            state = _NEXT[state]
            out.append((*last, at, "I", 0, True, _NAMES[state], "", None, None))
            at += 1

    def frame_of(rows):
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _EDIT.split(", ")])

    for frame in frames:
        if not len(frame):
            continue
        opens = _opens(frame["conv"].to_numpy(), frame["no_conv"].to_numpy(), last)
        columns = [frame[c].tolist() for c in ("conv", "no_conv", "pointer", "kind", "turn", "no_turn", "role", "text", "fault")]
        for new, conv, no_conv, pointer, kind, turn, no_turn, role, text, fault in zip(opens.tolist(), *columns, strict=True):
            if new:
                close()
                last, state, at = (conv, no_conv), _START, 0
            while (letter := LETTERS[pointer >> 2 * state & 3]) == "I":
                state = _NEXT[state]
                out.append((conv, no_conv, at, "I", 0, True, _NAMES[state], "", None, None))
                at += 1
            now = role
            if letter == "K":
                state = _kept(state, kind & 3)
            elif letter == "R":
                state = _NEXT[state]
                now = _NAMES[state]
            out.append((conv, no_conv, at, letter, turn, no_turn, now, text, role, fault))
            at += 1
        last = (frame["conv"].iat[-1], frame["no_conv"].iat[-1])
        if out:
            yield frame_of(out)
            out.clear()
    close()
    if out:
        yield frame_of(out)


def faults(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fault: each row's first fault, blank, duplicate or truncated, else null.

    Rows are dealt by conversation here and stay so; equal texts of a role are numbered in order of turn by a window that
    needs no further exchange. Null roles and texts read as one space.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    dealt = rows.repartition("conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    kept = F.rtrim("text", F.lit(BLANK))
    fault = (F.when(kept == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.substring(kept, -1, 1).isin(".", "!", "?"), "truncated"))
    return dealt.withColumn("nth", nth).withColumn("fault", fault)


def edits(conversations: DataFrame) -> DataFrame:
    """conv_id, at, edit, turn, role, text, old_role, fault: the cheapest edits that give each conversation roles ``s?(ua)+``.

    Rows stand in order of turn, then role and text (null turns first, a null conv_id is a conversation of its own).
    ``edit`` is K(eep), R(erole), D(elete) or I(nsert); of equally cheap sequences the ASCII-least is taken. ``role`` and ``text``
    are the repaired ones (for D those deleted). A role counts by its first letter; one that starts with none of s, u, a
    (the empty one too) can't be kept. A conversation of which nothing can stay loses all its rows.

    A conversation's rows go through one task in order, and no row is held longer than its batch. Streamed from the last
    turn, the dynamic program carries four costs across batches and spills one byte a row, the first edit of each state, into the
    rows; Spark's external sort then turns them round, and a second stream follows the bytes. So memory doesn't
    grow with a conversation, and a lost task starts again from the shuffle. Without rows there are no edits.
    """
    found = faults(conversations)
    initial = F.instr(F.lit(_INITIALS), F.substring("role", 1, 1)) - 1
    place = F.when((F.length("role") == 0) | (initial < 0), 3).otherwise(initial)
    must_go = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    kind = place + F.when(must_go, _MUST_GO).otherwise(0) + F.when(F.col("fault") == "truncated", _CUT).otherwise(0)
    rows = found.select(  # pandas would read 64-bit numbers with nulls as floats
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"),
        "role", "text", "fault", F.col("nth").cast("int").alias("nth"), kind.cast("int").alias("kind"))
    back = rows.sortWithinPartitions(
        "conv", "no_conv", F.asc("no_turn"), F.desc("turn"), F.desc("role"), F.desc("text"), F.desc("nth"))
    schema = "conv long, no_conv boolean, turn long, no_turn boolean, role string, text string, fault string, nth int, kind int, pointer int, back long"
    pointed = back.mapInPandas(_backward, schema).sortWithinPartitions("conv", "no_conv", F.desc("back"))
    done = pointed.mapInPandas(_forward, _EDIT)
    return done.select(
        _unless("no_conv", "conv").alias("conv_id"), "at", "edit", _unless("no_turn", "turn").alias("turn"), "role", "text", "old_role", "fault")


def _unless(absent: str, value: str) -> Column:
    return F.when(~F.col(absent), F.col(value))


_REPORT = "conv long, no_conv boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COST = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


class _Totals:
    """What the report says of one conversation, row by row."""

    def __init__(self):
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.audit, self.before, self.first, self.hash = [], None, True, hashlib.sha256()

    def add(self, edit, turn, no_turn, role, text, old_role, fault):
        self.audit.append(edit)
        self.cost += _COST[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "I":
            if fault is not None:
                self.faults[fault] += 1
            if self.before is not None and self.before + old_role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = old_role[:1]
            if not no_turn:
                self.turns += turn != self.turn
                self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        if edit != "D":
            said = f"{role}:{text}" if self.first else f"\n{role}:{text}"
            self.first = False
            self.hash.update(said.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def _reported(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _REPORT.split(", ")]
    last, totals = None, None
    for frame in frames:
        if not len(frame):
            continue
        out = []
        opens = _opens(frame["conv"].to_numpy(), frame["no_conv"].to_numpy(), last)
        columns = [frame[c].tolist() for c in ("conv", "no_conv", "edit", "turn", "no_turn", "role", "text", "old_role", "fault")]
        for new, conv, no_conv, *row in zip(opens.tolist(), *columns, strict=True):
            if new:
                if totals is not None:
                    out.append((*last, *totals.row()))
                last, totals = (conv, no_conv), _Totals()
            totals.add(*row)
        last = (frame["conv"].iat[-1], frame["no_conv"].iat[-1])
        if out:
            yield pd.DataFrame(out, columns=names)
    if totals is not None:
        yield pd.DataFrame([(*last, *totals.row())], columns=names)


def report(done: DataFrame) -> DataFrame:
    """One row per conversation of ``edits``: its faults, the cost, the edits' letters and the digest of what was repaired.

    ``done`` comes straight from ``edits`` (a conversation's rows together and in order). gaps beyond 64 bits read as 2^63 - 1.
    """
    rows = done.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), "edit",
        F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text", "old_role", "fault")
    found = rows.mapInPandas(_reported, _REPORT)
    return found.select(_unless("no_conv", "conv").alias("conv_id"), *[c.split()[0] for c in _REPORT.split(", ")[2:]])


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows damaged by a hash of conversation and turn, to try the repair on.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 sets role user.
    Nulls read as one space.
    """
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.pmod(F.crc32(named.cast("binary")), F.lit(20)).alias("hit"))
    text = (F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return (rows.where("hit <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time"))
            .drop("time"))


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``report`` of ``rows`` for every conv_id of ``conversations``; one without rows has nothing but zeros and empty texts."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = report(edits(rows))
    joined = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
