"""Connected components of a graph that is given as edges, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of `edges` (a, b): root is the smallest node of the component.

    Each round gives every node the smallest label among its neighbours, then the label of that
    label, so labels travel along paths that double in length. Rounds are written to the shared
    folder, so a lost executor costs one round at most.
    """
    both = edges.filter("a <> b").select("a", "b")
    both = stored(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("hook")
        )
        jump = labels.select(F.col("node").alias("hook"), F.col("root").alias("far"))
        moved = stored(
            hooked.join(jump, "hook").select("node", "old", F.least("hook", "far").alias("root")), "labels"
        )
        labels = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return labels
