"""Feeds loaded exactly once: tables laid out by key, batches that count only when their marker stands.

A feed lives below one folder: ``rows`` and ``rejects``, both in one folder per batch, and ``batches`` with a marker per
finished batch. Rows lie in ``SLOTS`` folders by a hash of their key, so a batch is compared only with the
slots that its own keys fall into, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.operators.ingest import read_or_empty, with_reject_reason
from corpuslens.session import materialise

SLOTS = 1024
_MARKER = "batch string, added bigint, rejected bigint"


def slot_of(keys: Sequence[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def batches(spark: SparkSession, root: str) -> DataFrame:
    """(batch, added, rejected) of the finished batches; a batch that broke off isn't among them."""
    return read_or_empty(spark, f"{root}/batches", spark.createDataFrame([], _MARKER).schema)


def _finished(spark: SparkSession, root: str, part: str, schema: T.StructType, extra: str) -> DataFrame:
    """Rows of ``part`` that belong to finished batches, with their folder columns."""
    whole = T.StructType([*schema, T.StructField("batch", T.StringType())])
    if extra:
        whole = whole.add(extra, T.IntegerType())
    rows = read_or_empty(spark, f"{root}/{part}", whole)
    return rows.join(batches(spark, root).select("batch"), "batch", "left_semi")


def loaded(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The feed's table: all rows of finished batches."""
    return _finished(spark, root, "rows", schema, "slot").select(*schema.names)


def rejected(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that were not inserted, with ``reject_reason`` and their batch."""
    found = _finished(spark, root, "rejects", T.StructType([*schema, T.StructField("reject_reason", T.StringType())]), "")
    return found.select(*schema.names, "reject_reason", "batch")


def met_rows(batch: DataFrame, root: str, keys: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The loaded rows in the slots of the batch's keys: the part of the table that an append has to read.

    At most ``slots`` numbers come to the driver, and the scan lists only their folders.
    """
    hit = [r["slot"] for r in batch.select(slot_of(keys, slots).alias("slot")).distinct().collect()]
    target = _finished(batch.sparkSession, root, "rows", batch.schema, "slot")
    return target.where(F.col("slot").isin(hit)).select(*batch.columns)


def load(
    batch: DataFrame,
    root: str,
    batch_id: str,
    keys: Sequence[str],
    order: Sequence[str],
    rules: Sequence[Column] = (),
    slots: int = SLOTS,
) -> tuple[int, int]:
    """Insert the new keys of a batch and store the other rows with their reason; returns (added, rejected).

    What becomes of each row is decided once and written; then rows and rejects go to the batch's own folders,
    which a second try overwrites, and the marker comes last. So a batch that breaks off at any point leaves nothing that
    counts, and one that is run again after its marker does nothing. One writer at a time, as in any keyed load.
    """
    spark = batch.sparkSession
    done = batches(spark, root).where(F.col("batch") == batch_id).select("added", "rejected").first()
    if done is not None:
        return done["added"], done["rejected"]
    target = met_rows(batch, root, keys, slots)
    decided = materialise(with_reject_reason(batch, target, keys, order, rules))
    counts = decided.agg(F.count_if(F.col("reject_reason").isNull()), F.count("reject_reason")).first()
    good = decided.where("reject_reason is null").drop("reject_reason").withColumn("slot", slot_of(keys, slots))
    by_slot = good.repartition("slot").sortWithinPartitions("slot", *keys)
    by_slot.write.mode("overwrite").partitionBy("slot").parquet(f"{root}/rows/batch={batch_id}")
    decided.where("reject_reason is not null").write.mode("overwrite").parquet(f"{root}/rejects/batch={batch_id}")
    marker = spark.createDataFrame([(batch_id, *counts)], _MARKER)
    marker.coalesce(1).write.mode("append").parquet(f"{root}/batches")
    return tuple(counts)


def newer_pages(
    entries: DataFrame, known: DataFrame, keys: Sequence[str], full: int | None = None, page: str = "page"
) -> DataFrame:
    """Unknown entries of a listing that shows its newest first, up to the first page that isn't full of them.

    ``full`` is the number of entries of a full page, by default what each page itself lists. Pages are taken in blocks
    that double in length, each by a filter on the page number that prunes a scan sorted by it; pages behind the
    block with the last one are never read. Missing pages are passed over. Only page numbers reach the driver.
    """
    last = entries.agg(F.max(page)).first()[0]
    low, size, taken = entries.agg(F.min(page)).first()[0], 1, []
    while last is not None and low <= last:
        block = materialise(entries.where(F.col(page).between(low, low + size - 1)))
        fresh = materialise(block.join(known.select(*keys), list(keys), "left_anti").select(*entries.columns))
        listed = block.groupBy(page).agg(F.count(F.lit(1)).alias("listed"))
        new = fresh.groupBy(page).agg(F.count(F.lit(1)).alias("new"))
        want = F.col("listed") if full is None else F.lit(full)
        ends = listed.join(new, page, "left").where(F.coalesce("new", F.lit(0)) < want)
        end = ends.agg(F.min(page)).first()[0]
        taken.append(fresh if end is None else fresh.where(F.col(page) <= end))
        if end is not None:
            break
        low, size = low + size, 2 * size
    return reduce(DataFrame.union, taken) if taken else entries.limit(0)


def write_back(path: str, ids: Sequence[str], changed: DataFrame, spark: SparkSession, parts: int = SLOTS) -> int:
    """Put ``changed`` rows in place of those with the same ids in the table at ``path``; returns how many really differ.

    The table lies in folders ``slot`` by a hash of its ids. Only folders with a row that differs are read whole, written
    anew beside the table and then exchanged by a dynamic partition overwrite; the others aren't touched, and a second
    run finds nothing to change. Ids must be unique in ``changed``.
    """
    table = spark.read.schema(T.StructType([*changed.schema, T.StructField("slot", T.IntegerType())])).parquet(path)
    new = materialise(changed.withColumn("slot", slot_of(ids, parts)))
    hit = [r["slot"] for r in new.select("slot").distinct().collect()]  # at most ``parts``
    mine = table.where(F.col("slot").isin(hit))
    rest = [c for c in changed.columns if c not in ids]
    state = F.struct(*rest)
    pairs = mine.select("slot", *ids, state.alias("old")).join(new.select("slot", *ids, state.alias("new")), ["slot", *ids])
    differ = materialise(pairs.where(~F.col("old").eqNullSafe(F.col("new"))).select("slot", *ids, "new"))
    n = differ.count()
    if n:
        touched = [r["slot"] for r in differ.select("slot").distinct().collect()]
        joined = table.where(F.col("slot").isin(touched)).join(differ, ["slot", *ids], "left")
        merged = [F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in rest]
        staged = materialise(joined.select(*ids, *merged, "slot"))
        out = staged.select(*changed.columns, "slot").repartition("slot")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(path)
    return n


def laid_out(rows: DataFrame, path: str, ids: Sequence[str], parts: int = SLOTS) -> None:
    """Write a table in the layout that ``write_back`` needs."""
    rows.withColumn("slot", slot_of(ids, parts)).repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(path)
