"""Message threads from a stream, with the authors of one hash in one state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpuslens.functions.text import drop_leading_dots, drop_trailing_dots
from corpuslens.operators.threads import OpenThread, step

# times are microseconds since 1970 while rows are in Python or in a state
_MESSAGE = pa.schema([
    ("author", pa.int64()), ("tweet_id", pa.int64()), ("at", pa.int64()), ("text", pa.string()), ("piece", pa.string()),
    ("more", pa.int8()), ("is_rt", pa.int8()),
])
_OPEN = pa.schema([
    ("author", pa.int64()), ("start", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("last_ts", pa.int64()),
    ("pieces", pa.list_(pa.string())),
])
_STATE = "waiting binary, opened binary"
_OUT = "author bigint, end_id bigint, text string, t_start bigint, t_end bigint, is_rt boolean, late boolean"
_OUT_COLUMNS = ("author", "end_id", "text", "t_start", "t_end", "is_rt", "late")
_NOBODY = -1  # the state of messages without an author
_NO_ID = -(1 << 63)  # stands for a missing id, so that ids stay whole numbers in pandas
_UNKNOWN = 2  # stands for a missing ``is_rt``


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(packed)).read_all()


def _rows(table: pa.Table) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in table.columns))


def _open_threads(packed: bytes, compat: bool) -> dict[int, OpenThread]:
    found = {}
    for author, *fields in _rows(_unpacked(packed)):
        thread = found[author] = OpenThread(compat)
        thread.start, thread.first_id, thread.last_id, thread.last_ts, thread.pieces = fields
    return found


def _packed_threads(opened: dict[int, OpenThread]) -> bytes:
    rows = [(a, t.start, t.first_id, t.last_id, t.last_ts, t.pieces) for a, t in opened.items()]
    columns = zip(*rows) if rows else [()] * len(_OPEN)
    return _packed(pa.Table.from_arrays([pa.array(c, field.type) for c, field in zip(columns, _OPEN)], schema=_OPEN))


def _advance(latency: int, compat: bool):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark_ms = state.getCurrentWatermarkMs()
        watermark = watermark_ms * 1000
        arrived, opened, out = [_MESSAGE.empty_table()], {}, []
        for batch in batches:
            arrived.append(pa.Table.from_pandas(batch[_MESSAGE.names], _MESSAGE, preserve_index=False))
        waiting = pa.concat_tables(arrived)
        behind = pc.less(waiting["at"], watermark)
        for author, tweet_id, at, text, _, _, is_rt in _rows(waiting.filter(behind)):
            out.append((author, tweet_id, text, at, at, None if is_rt == _UNKNOWN else is_rt == 1, True))
        waiting = waiting.filter(pc.invert(behind))
        if state.exists:
            packed, threads = state.get
            waiting, opened = pa.concat_tables([_unpacked(packed), waiting]), _open_threads(threads, compat)

        due = pc.less(waiting["at"], watermark)
        ready = waiting.filter(due).sort_by([(name, "ascending") for name in _MESSAGE.names])
        waiting = waiting.filter(pc.invert(due))
        for author, tweet_id, at, text, piece, more, is_rt in _rows(ready):
            if is_rt == 1:
                out.append((author, tweet_id, text, at, at, True, False))
                continue
            thread = opened.get(author) or opened.setdefault(author, OpenThread(compat))
            done = step(thread, tweet_id, at, text, piece, more, latency)
            out += [(author, end_id, t, a, b, False, False) for end_id, _, t, a, b in done]
        for author, thread in opened.items():
            if thread.start is not None and thread.start + latency <= watermark:
                end_id, _, t, a, b = thread.expire()
                out.append((author, end_id, t, a, b, False, False))
        opened = {author: thread for author, thread in opened.items() if thread.start is not None}

        if len(waiting) or opened:
            state.update((_packed(waiting.combine_chunks()), _packed_threads(opened)))
            # a timer runs off once the watermark is past it: past a message's millisecond, or at a thread's full age
            timers = [pc.min(waiting["at"]).as_py() // 1000] if len(waiting) else []
            timers += [(min(t.start for t in opened.values()) + latency - 1) // 1000] if opened else []
            state.setTimeoutTimestamp(max(min(timers), watermark_ms, 1))
        elif state.exists:
            state.remove()
        if out:
            rows = pd.DataFrame(out, columns=list(_OUT_COLUMNS), dtype=object)
            if key[0] == _NOBODY:
                rows["author"] = None
            rows.loc[rows["end_id"] == _NO_ID, "end_id"] = None
            yield rows

    return run


def thread_stream(
    tweets: DataFrame, latency_seconds: int, delay: str, compat: bool = False, states: int = 2048
) -> DataFrame:
    """Threads of a stream of messages (author, tweet_id, text, ts, is_rt, more).

    Messages wait until the watermark (``delay`` behind the newest message) passes them and are then
    taken in id order, which replaces the hold-back of young threads in the batch form. A timer
    ``latency`` after a thread's start closes it for age. Messages behind the watermark come out
    with ``late`` set, for a reject table; they never join a thread. Messages without a time are left out.

    Authors are dealt by hash over ``states`` states, since a call per author costs far more than its messages; each
    author's messages are still taken by themselves. A trigger rewrites the states it touches, which hold what arrived within
    ``delay`` and the open threads, so a stream of more authors should take more states. A checkpoint is bound to the number.
    """
    text = F.when(F.col("is_rt"), F.col("text")).otherwise(drop_leading_dots(F.col("text")))
    rows = tweets.withColumn("text", text).withColumn("piece", drop_trailing_dots(F.col("text")))
    dealt = rows.withWatermark("ts", delay).where(F.col("ts").isNotNull()).select(
        F.when(F.col("author").isNull(), _NOBODY).otherwise(F.pmod(F.xxhash64("author"), F.lit(states))).alias("state"),
        F.coalesce("author", F.lit(0)).alias("author"), F.coalesce("tweet_id", F.lit(_NO_ID)).alias("tweet_id"),
        "ts", F.unix_micros("ts").alias("at"), "text", "piece", F.coalesce("more", F.lit(0)).cast("tinyint").alias("more"),
        F.coalesce(F.col("is_rt").cast("tinyint"), F.lit(_UNKNOWN)).cast("tinyint").alias("is_rt"))
    threads = dealt.groupBy("state").applyInPandasWithState(
        _advance(latency_seconds * 1_000_000, compat), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return threads.withColumns({"t_start": F.timestamp_micros("t_start"), "t_end": F.timestamp_micros("t_end")})
