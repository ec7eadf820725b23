"""Connected components of a graph that is only known as a table of edges."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze


def connected(edges: DataFrame) -> DataFrame:
    """``v, component`` for every vertex of ``edges`` (``a, b``): the smallest vertex reachable.

    Every round points each vertex to its smallest neighbour, if that is smaller, follows the
    pointer of that neighbour, and contracts the edges to the vertices pointed at; edges inside a
    contracted group are gone, so the graph shrinks from round to round.  Each round is written
    to the shared folder; only whether edges are left comes to the driver.
    """
    edges = freeze(edges.select("a", "b").filter("a <> b").distinct())
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = freeze(both.groupBy("a").agg(F.min("b").alias("low"))
                      .select(F.col("a").alias("v"), F.least("a", "low").alias("to")))
        onward = near.select(F.col("v").alias("of"), F.col("to").alias("on"))
        step = freeze(near.join(onward, near["to"] == onward["of"], "left")
                      .select("v", F.coalesce("on", "to").alias("to")))
        if labels is None:
            labels = step.withColumnRenamed("to", "component")
        else:
            labels = freeze(labels.join(step.withColumnRenamed("v", "of"), F.col("component") == F.col("of"), "left")
                            .select(labels["v"], F.coalesce("to", "component").alias("component")))
        from_a = step.select(F.col("v").alias("a"), F.col("to").alias("to_a"))
        from_b = step.select(F.col("v").alias("b"), F.col("to").alias("to_b"))
        edges = freeze(edges.join(from_a, "a").join(from_b, "b").filter("to_a <> to_b")
                       .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    return labels
