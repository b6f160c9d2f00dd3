"""Keyed appends from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from corpuslens.operators import feeds
from corpuslens.operators.ingest import append_keyed


def keyed_sink(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> DataStreamWriter:
    """Append each micro-batch's new keys to the table at ``path``.

    Source offsets are kept by the checkpoint, so the high-water mark needs no query. A batch that
    is run again after a failure adds nothing, since its keys are then already there.
    """

    def add(batch: DataFrame, _: int) -> None:
        append_keyed(batch, path, keys, order)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def feed_sink(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], slots: int = feeds.SLOTS
) -> DataStreamWriter:
    """Load each micro-batch into the feed below ``root`` under its number, reading only the slots its keys fall into.

    A micro-batch that is run again after a failure overwrites what it had begun, or does nothing if it had finished.
    """

    def add(batch: DataFrame, number: int) -> None:
        feeds.load(batch, root, f"stream-{number}", keys, order, slots=slots)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
