"""Connected components of links held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of ``links`` (``a``, ``b``).

    Labels spread over links and then jump to the labels of labels, so the number of rounds grows with the logarithm
    of a component's diameter. A hub's links are combined before they are shuffled. Every round is a written table.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = written(both.distinct(), "edges")
    labels = written(edges.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("label")), "labels")
    while True:
        far = edges.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other")
        least = far.groupBy("node").agg(F.min("seen").alias("seen"))
        spread = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        spread = spread.join(jump, "label").select("node", "old", F.least("label", "beyond").alias("label"))
        spread = written(spread, "labels")
        labels = spread.select("node", "label")
        if spread.filter("old <> label").isEmpty():
            return labels
