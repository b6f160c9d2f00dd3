"""Split dates of a data set from a JSON file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPLIT_SCHEMA = ", ".join(
    f"{part}_{end}_date date" for part in ("train", "val", "test") for end in ("start", "end")
)


def split_dates(spark: SparkSession, path: str) -> DataFrame:
    """One row with the first and last dates of the train, val and test parts."""
    return spark.read.schema(SPLIT_SCHEMA).json(path, multiLine=True, dateFormat="yyyy-MM-dd")
