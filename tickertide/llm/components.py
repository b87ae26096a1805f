"""Connected components of a table of links, by minimum labels and pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.sources.handover import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): label is the smallest node of the component.

    Each round takes the smallest label among neighbours, then the label of the label, so the number of
    rounds grows with the logarithm of a component's width. Labels are written after each round.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = materialise(both, "links")
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("_to"), F.col("label").alias("_next"))
        jumped = lower.join(jump, F.col("label") == F.col("_to"), "left")
        new = materialise(jumped.select("node", "old", F.least("label", "_next").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter("label <> old").isEmpty():
            return labels
