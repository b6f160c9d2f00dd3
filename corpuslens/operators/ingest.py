"""Incremental, idempotent loading: high-water marks, keyed appends, rejects and table checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions.scores import confusion_flags
from corpuslens.functions.text import text_hash, word_count
from corpuslens.plans.ranks import global_rank
from corpuslens.plans.skew import lookup_join

BEGINNING_OF_TIME = "1900-01-01"


def high_water_mark(target: DataFrame, column: str, default: Column, only: Column | None = None) -> DataFrame:
    """(latest, initial_load): the largest value in the target, or the default on an empty one."""
    rows = target if only is None else target.where(only)
    top = F.max(column)
    return rows.agg(F.coalesce(top, default).alias("latest"), top.isNull().alias("initial_load"))


def newer_rows(batch: DataFrame, mark: DataFrame, column: str, inclusive: bool = True) -> DataFrame:
    """All rows on an initial load, else those from the high-water mark on."""
    m = mark.select(F.struct("*")).scalar()
    value = F.col(column)
    late = value >= m["latest"] if inclusive else value > m["latest"]
    return batch.where(m["initial_load"] | late)


def unknown_ids(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target does not hold."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; copies of a hot key collapse before the shuffle."""
    first = F.min_by(F.struct(*batch.columns), F.struct(*order))
    return batch.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(first.alias("r")).select("r.*")


def rows_to_insert(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The batch under an insert that keeps the first row per key and skips keys already there."""
    return unknown_ids(first_per_key(batch, keys, order), target, keys)


def _has_reason(reason: str, condition: Column) -> Column:
    return F.when(condition, F.lit(reason))


def broken_rules(schema: T.StructType) -> list[Column]:
    """Reasons a row breaks its table's rules: nulls in required columns. Text may have any length."""
    return [_has_reason(f"null:{f.name}", F.col(f.name).isNull()) for f in schema if not f.nullable]


def with_reject_reason(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rules: Sequence[Column] = (),
    parent: DataFrame | None = None,
    parent_keys: Sequence[str] = (),
) -> DataFrame:
    """Every batch row with ``reject_reason``, NULL when it would be inserted.

    ``order`` must be unique within a key. Reasons, first that applies: a broken rule, a missing
    parent row, an existing key, an earlier row of the batch with the same key. Rejected rows
    never displace a good row with the same key.
    """
    keys, order = list(keys), list(order)
    checked = batch.withColumn("__bad", F.coalesce(*rules) if rules else F.lit(None).cast("string"))
    if parent is not None:
        known = parent.select(*parent_keys).distinct().withColumn("__parent", F.lit(True))
        checked = lookup_join(checked, known, list(parent_keys), order, "left")
        checked = checked.withColumn("__bad", F.coalesce("__bad", _has_reason("no_parent", F.col("__parent").isNull())))
    place = F.struct(*order)
    firsts = checked.where(F.col("__bad").isNull()).groupBy(*keys).agg(F.min(place).alias("__first"))
    there = target.select(*keys).distinct().withColumn("__there", F.lit(True))
    marked = lookup_join(checked, firsts.join(there, keys, "left"), keys, order, "left")
    reason = F.coalesce(
        F.col("__bad"),
        _has_reason("exists", F.col("__there")),
        _has_reason("duplicate_in_batch", place > F.col("__first")),
    )
    return marked.withColumn("reject_reason", reason).select(*batch.columns, "reject_reason")


def claim_rowset(claims: DataFrame) -> DataFrame:
    """Claims in insert order with the hash of their text."""
    return claims.select(
        "iid", "statement_text", "repeats", "topic", "source", "pinnochios", "s_date",
        text_hash(F.col("statement_text")).alias("statement_hash"),
    )


def tweet_rowset(threads: DataFrame) -> DataFrame:
    """Threads in insert order with the repost flag as a number and the hash of their text."""
    return threads.select(
        F.col("end_id").alias("end_thread_tweet_id"),
        F.col("text").alias("statement_text"),
        F.col("t_start").alias("t_start_date"),
        F.col("t_end").alias("t_end_date"),
        F.col("is_rt").cast("int").alias("retweet"),
        text_hash(F.col("text")).alias("statement_hash"),
    )


def statement_rowset(statements: DataFrame) -> DataFrame:
    return statements.select("tid", "sid", "statement_text", "sentiment")


def transcript_rowset(transcripts: DataFrame) -> DataFrame:
    return transcripts.select("tid", "t_date", "transcript_type", "transcript_url", "transcript_sent")


def with_word_count(df: DataFrame) -> DataFrame:
    """Add the generated column ``wc``."""
    return df.withColumn("wc", word_count(F.col("statement_text")))


def with_generated_flags(df: DataFrame) -> DataFrame:
    """Add the generated columns tp, fp, tn, fn."""
    return df.withColumns(confusion_flags())


def with_surrogate_key(new_rows: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Number new rows by ``order`` after the largest key of the target. ``order`` must be unique."""
    last = target.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
    return global_rank(new_rows, order, "__rn").withColumn(key, last + F.col("__rn")).drop("__rn")


def seeded_dimension(spark: SparkSession, key: str, column: str, names: Sequence[str]) -> DataFrame:
    """A small dimension table with keys from 1."""
    return spark.createDataFrame(list(enumerate(names, 1)), f"{key} int, {column} string")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n): NULLs in columns that must not have any; one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return counts.select(F.inline(pairs)).where(F.col("n") > 0)


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows left after the deleted parents take theirs along."""
    return child.join(deleted.select(*keys), list(keys), "left_anti")


def snapshot(view: DataFrame, path: str) -> DataFrame:
    """Store a view's current rows as a table and return the table."""
    view.write.mode("overwrite").parquet(path)
    return view.sparkSession.read.schema(view.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, or an empty one before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_keyed(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Insert the batch's new keys into the table at ``path``; returns the number of rows added."""
    target = read_or_empty(batch.sparkSession, path, batch.schema)
    added = Observation("added")
    rows = rows_to_insert(batch, target, keys, order).observe(added, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").parquet(path)
    return added.get["n"]


def load_with_rejects(
    batch: DataFrame,
    path: str,
    rejects_path: str,
    keys: Sequence[str],
    order: Sequence[str],
    rules: Sequence[Column] = (),
    batch_id: str | None = None,
) -> tuple[int, int]:
    """Insert a batch and store the rows that were not inserted with their reason.

    Returns the numbers of rows added and rejected. Unlike ``append_keyed`` nothing is dropped silently. What becomes
    of each row is decided once per ``batch_id`` (one of its own for every call by default) and stored below the rejects;
    a batch that is run again after a failure keeps those decisions, adds what is still missing and writes its rejects
    over the earlier ones.
    """
    spark, batch_id = batch.sparkSession, batch_id or uuid.uuid4().hex
    decided = f"{rejects_path}/_decided/{batch_id}"  # readers of the rejects pass over the underscore
    schema = T.StructType([*batch.schema, T.StructField("reject_reason", T.StringType())])
    marked = read_or_empty(spark, decided, schema)
    if marked.isEmpty():
        target = read_or_empty(spark, path, batch.schema)
        with_reject_reason(batch, target, keys, order, rules).write.mode("overwrite").parquet(decided)
        marked = spark.read.schema(schema).parquet(decided)
    added = append_keyed(marked.where("reject_reason is null").drop("reject_reason"), path, keys, order)
    rejected = Observation("rejected")
    bad = marked.where("reject_reason is not null").observe(rejected, F.count(F.lit(1)).alias("n"))
    bad.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
    return added, rejected.get["n"]


def read_jdbc(
    spark: SparkSession, url: str, query: str, column: str, bounds: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    """A query on an external database, read in parallel over ranges of a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options)
    split = {"lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions}
    return reader.options(partitionColumn=column, **split).load()


def sql_frame(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A SQL query over named frames, written ``{name}`` in the text."""
    return spark.sql(query, **tables)
