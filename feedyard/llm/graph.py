"""Connected components of an edge table, by contraction.

Each round maps every node to its smallest neighbour (or itself), rewrites
the edges by that map and drops loops; the graph at least halves, and star
shaped graphs vanish in one round. The maps are then applied one after the
other. Every round is written to the shared folder; no edge or label reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import landed


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> node, label: the label is one of the
    component's nodes. Loops give a node its own component unless it has
    other edges."""
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    edges = edges.where(F.col("a") != F.col("b"))
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = landed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "component-map")
        maps.append(step)
        edges = landed(
            edges.join(step, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
            .join(step, "a").select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
            .where(F.col("a") != F.col("b")).distinct(),
            "component-edges",
        )
    labels = nodes.withColumn("label", F.col("node"))
    for step in maps:
        labels = labels.join(step.withColumnRenamed("a", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label"))
    return labels
