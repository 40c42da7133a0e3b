"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b): the least node it is connected to.

    Each round gives a node the least label among its neighbours and then the label of its
    label, so labels travel twice as far each time. Rounds are stored; the loop ends when
    none changed. Nodes of very high degree combine before the shuffle.
    """
    edges = edges.where("a <> b")
    back = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    both = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(back).distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
    )
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("component").alias("seen"))
        nearest = (
            both.join(of_other, "other").groupBy("node").agg(F.min("seen").alias("nearest"))
        )
        lower = labels.join(nearest, "node").select(
            "node", "component", F.least("component", "nearest").alias("lower")
        )
        # A label's own label is never above it.
        of_label = labels.select(F.col("node").alias("lower"), F.col("component").alias("jump"))
        jumped = stored(
            lower.join(of_label, "lower", "left").select(
                "node",
                F.least("lower", "jump").alias("component"),
                (F.least("lower", "jump") < F.col("component")).alias("changed"),
            ),
            "labels",
        )
        labels = jumped.drop("changed")
        if jumped.where("changed").isEmpty():
            return labels
