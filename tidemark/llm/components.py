"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the
    smallest node that can be reached.

    Every round takes the smallest label among the neighbours and then the label
    of that label, so that labels cross a path in a logarithmic number of rounds
    for the shallow groups that near copies form.  The labels of each round are
    stored; only the number of changed labels reaches the driver.
    """
    both = stored(
        links.select("a", "b")
        .union(links.select("b", "a"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.min(F.least("a", "b")).alias("component"), F.lit(True).alias("changed")
    )
    labels = stored(labels)
    while labels.where("changed").limit(1).count():
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("low")
        )
        # A label is itself a node: follow it to its own label.
        ahead = labels.select(F.col("node").alias("low"), F.col("component").alias("far"))
        labels = stored(
            lower.join(ahead, "low")
            .select("node", "was", F.least("low", "far").alias("component"))
            .select("node", "component", (F.col("component") < F.col("was")).alias("changed"))
        )
    return labels.select("node", "component")
