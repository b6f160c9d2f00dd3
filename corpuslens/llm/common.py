"""What the operators share: inputs, label folds, stored tables, mapping over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Later reads agree even after lost executors, and they prune columns and filter in the scan.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id, parts: int):
    """The document's fold: crc32 of the id as text, modulo ``parts`` (a null id: fold 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def known_labels(labels: DataFrame, label: str, where=None) -> DataFrame:
    """(doc_id, label) of all rows with a label, one per doc_id."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return known if where is None else known.where(where)


def labelled(docs: DataFrame, labels: DataFrame, label: str, where=None, limit: int | None = None) -> DataFrame:
    """(doc_id, text, label) of rows with a label, one per doc_id; ``limit`` keeps those first by a hash of the id."""
    known = known_labels(labels, label, where)
    if limit is not None:
        known = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))  # at most ``limit`` ids
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(known, "doc_id").dropDuplicates(["doc_id", "text"])


def map_texts(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``function`` to Arrow batches of ``df``; empty batches are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def filter_texts(docs: DataFrame, accept: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The rows of ``docs`` whose text ``accept`` lets through, all their columns untouched."""
    at = [name.lower() for name in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(accept(batch.column(at)))

    return docs.mapInArrow(run, docs.schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """Whole texts one at a time; null reads as empty."""
    return strings(batch.column(column))


def strings(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""
