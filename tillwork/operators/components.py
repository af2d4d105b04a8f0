"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.session import stored

DRIVER_EDGES = 100_000


def connected_components(edges: DataFrame, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """(node, component) with the smallest node of each component, for edges (a, b).

    A graph known to have few edges is solved on the driver. Otherwise every node takes the
    smallest label among its neighbours and then the label of its label, until nothing changes;
    following labels halves the remaining distance, so few rounds are needed.
    """
    edges = stored(edges.select("a", "b").distinct())
    few = edges.limit(driver_edges + 1).collect()
    if len(few) <= driver_edges:
        return _on_driver(edges, few)
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")
    )
    labels = stored(labels)
    while True:
        # Minimum over the neighbours is combined before the shuffle, so a hub costs little.
        offered = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("offer"))
        )
        lower = labels.join(offered, "node").select(
            "node", F.least("component", "offer").alias("step"), F.col("component").alias("old")
        )
        jump = labels.select(F.col("node").alias("step"), F.col("component").alias("next"))
        moved = stored(
            lower.join(jump, "step").select("node", F.least("step", "next").alias("component"), "old")
        )
        if moved.where("component <> old").limit(1).count() == 0:
            return moved.select("node", "component")
        labels = moved.select("node", "component")


def _on_driver(edges: DataFrame, rows) -> DataFrame:
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in rows:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    dtype = edges.schema["a"].dataType.simpleString()
    found = [(x, find(x)) for x in list(parent)]
    return edges.sparkSession.createDataFrame(found, f"node {dtype}, component {dtype}")
