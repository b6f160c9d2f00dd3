"""Joins of rows with hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 2  # a key is hot when it alone has more rows than this many average shuffle partitions


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    count_on: DataFrame | None = None,
    hot: float = HOT,
) -> DataFrame:
    """Join ``df``, where one key may hold much of the data, to ``lookup``, which has one row per key.

    AQE does not split a hot key when the other side is already aggregated on that key. So keys are
    counted first (in ``count_on`` if ``df`` is costly). A key with more rows than ``hot`` average shuffle
    partitions is spread over one copy of its lookup row per average partition, so copies never exceed the
    partitions, whatever the size of the data; rows with a NULL key, which match nothing, are spread too. The salt comes
    from columns of the row (``spread_by``), so a task that is run again sends its rows to the same places.
    """
    keys = list(keys)
    counted = df if count_on is None else count_on
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    average = F.greatest(F.lit(1.0), counted.agg(F.count(F.lit(1)) / parts).scalar())
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    split = sizes.where(F.col("__n") > hot * average)
    heavy = F.broadcast(split.select(*keys, F.ceil(F.col("__n") / average).cast("bigint").alias("__salts")))  # fewer than parts

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    salts = F.coalesce("__salts", F.when(no_key, F.lit(parts).cast("bigint")).otherwise(one))
    salted = df.join(heavy, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*spread_by), salts))
    copies = lookup.join(heavy, keys, "left").withColumn(
        "__salt", F.explode(F.sequence(none, F.coalesce("__salts", one) - 1)))
    return salted.drop("__salts").join(copies.drop("__salts"), [*keys, "__salt"], how).drop("__salt")
