"""One query per operator over the test tables, and the same rows in plain SQL where SQL has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import chat, collocations, compression, decontaminate, licenses, mixing, neardups, oracle, pii, repair, rules, secrets, substrings, subwords
from corpuslens.llm.common import fold, table


def round_weights(sources: list[str | None]) -> dict[str | None, float]:
    """5, 2, 1 in turn, sources by code point, null last."""
    return {name: float((5, 2, 1)[k % 3]) for k, name in enumerate(sources)}


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = subwords.train(docs, labels, where=fold(F.col("doc_id"), 5) != 0)
    return subwords.classify(docs, model, 0.3)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), round_weights)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def op6_chat_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", plain), (-7, 1, "assistant", plain)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.prefix_examples(turns.union(extra)))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardups.link(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return compression.classify(docs, compression.train(docs, labels, where=fold(F.col("doc_id"), 3) != 1))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents")).drop("row")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(table(spark, sf_dir, "documents")).drop("row")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_report(turns, repair.damaged(turns))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scan": op2_license_scan,
    "op3_mix_sources": op3_mix_sources,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_prefixes": op6_chat_prefixes,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_substring_dedup": op10_substring_dedup,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_collocations": op11_collocations,
    "op12_pii_scan": op12_pii_scan,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {"op6_chat_prefixes": oracle.CHAT, "op10_substring_dedup": oracle.SUBSTRINGS, "op11_collocations": oracle.COLLOCATIONS,
           "op13_conversation_repair": oracle.REPAIR}
