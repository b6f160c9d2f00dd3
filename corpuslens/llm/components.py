"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that can be reached.

    Each round a node takes the smallest label among its own and its neighbours' and then the label of that
    label, so long chains shrink by halves. Labels are written to the shared folder every round; nothing but
    whether a label changed reaches the driver. Without edges the result is empty.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a != b").distinct(), "cc-edges")
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = stored(first.select("node", F.least("node", "near").alias("component"), F.lit(True).alias("changed")), "cc-labels")
    while not labels.where("changed").isEmpty():
        known = labels.select("node", "component")
        near = both.join(known.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        taken = known.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = known.select(F.col("node").alias("to"), F.col("component").alias("component"))
        labels = stored(
            taken.join(jump, "to").select("node", "component", (F.col("component") != F.col("old")).alias("changed")),
            "cc-labels")
    return labels.select("node", "component")
