"""Connected components by repeated joins: least labels of neighbours, and jumps to the label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilegate.llm.tables import Work


def components(work: Work, links: DataFrame) -> DataFrame:
    """node and the least node reachable, for every node of ``links`` (a, b: long).

    A hub's neighbours are folded by the aggregation and its own links are split by the join, so a node may have any
    number of links. Jumping halves the way to the least label, so long chains take a logarithmic number of rounds.
    """
    both = work.land(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = work.land(labels, "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("low"))
        lower = work.land(lower, "lower")
        ends = lower.select(F.col("node").alias("at"), F.col("low").alias("end"))
        after = lower.join(ends, F.col("low") == F.col("at")).select("node", F.col("end").alias("label"), (F.col("end") != F.col("label")).alias("moved"))
        after = work.land(after, "labels")
        if after.filter("moved").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
