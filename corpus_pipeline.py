"""The documents' way to a training set: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import decontaminate, mixing, neardups, rules, secrets
from corpuslens.llm.common import stored, table
from corpuslens.llm.queries import round_weights

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest, fitted on the labels of ``sf_dir``."""
    forest = rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rules.accepted(docs, forest)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return neardups.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, with its columns and texts and how often the mix takes it: size, source_size, target, copies, taken.

    A column of the documents with one of these names gives way to it.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    place = "place"
    while place in {c.lower() for c in docs.columns}:
        place += "_"
    rows = stored(docs.withColumn(place, F.monotonically_increasing_id()), "mix-rows")
    mixed = mixing.mix(rows, round_weights, carry=[place]).select(place, *added)
    kept = [c for c in docs.columns if c.lower() not in added]
    return rows.select(place, *kept).join(mixed, place).select(*kept, *added)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
]

ORACLE_SQL = None  # forest, MinHash, random walks and dependent rounding have no SQL form; tests hold them against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
