"""Connected components of a graph by joins; every round is stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, label)``, the label being the smallest node of its component.

    A round gives each node the smallest label around it, then the label of that label, so chains halve.  Nothing is
    gathered: a node with very many links is one key of a minimum that is combined before the shuffle.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(around, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("next"))
        above = labels.select(F.col("node").alias("next"), F.col("label").alias("above"))
        step = written(best.join(above, "next").select("node", F.least("next", "above").alias("new"), "label"), "labels")
        labels = step.select("node", F.col("new").alias("label"))
        if step.where("new <> label").isEmpty():
            return labels
