"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for all nodes of links (a, b).

    Each round a node takes the smallest label among its own and its neighbours', then the label of that label: labels
    travel along links and jump, so the number of rounds grows with the logarithm of the longest path. Minima are
    merged before each shuffle, and labels are unique per node, so a node with very many links splits over tasks.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        moved = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        moved = stored(moved, "moved")
        target = moved.select(F.col("node").alias("now"), F.col("now").alias("next"))
        jumped = moved.join(target, "now").select("node", "was", F.least("now", "next").alias("component"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.filter("component < was").isEmpty():
            return labels
