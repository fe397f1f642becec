"""Connected components of a graph that stays in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """u, v (long) -> node, component: the smallest node that can be reached.

    Every round takes the smallest label among a node's neighbours, then the label of that label,
    so rounds grow with the logarithm of a chain's length. Labels are written after each round;
    sums by node are taken on the map side first, as a node may have very many edges. Only nodes
    with edges are returned.
    """
    both = written(
        edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        .filter("u <> v")
        .distinct(),
        "graph-edges",
    )
    labels = written(
        both.groupBy(F.col("u").alias("node")).agg(
            F.least(F.min("v"), F.first("u")).alias("component")
        ),
        "graph-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = written(
            labels.join(near, "node").select(
                "node",
                F.least("component", "near").alias("component"),
                (F.col("near") < F.col("component")).alias("moved"),
            ),
            "graph-labels",
        )
        if lower.filter("moved").isEmpty():
            return labels
        above = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = written(
            lower.join(above, "component").select("node", F.col("next").alias("component")),
            "graph-labels",
        )
