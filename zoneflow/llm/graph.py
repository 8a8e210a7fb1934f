"""Connected components of an edge table that may not fit any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.session import materialize


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, root)`` for every node with an edge, ``root`` being the smallest node of its component.

    ``edges`` has two long columns ``a`` and ``b``; direction, loops and repeats do not matter, a null end drops the edge.

    Every round points a node at its smallest smaller neighbour and hands its other smaller neighbours on to that one
    (``b - m`` instead of ``a - b``), then lets every pointer skip one step. Components never change, larger ends only
    sink, and a round is a few aggregations and joins on nodes; each is written to the shared folder, so a lost executor
    costs one round. The rounds end when every node has one smaller neighbour that has none itself: a star per root.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    current = materialize(
        edges.filter(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct(), f"{label}-edges")
    while True:
        parents = materialize(current.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), f"{label}-parents")
        above = parents.select(F.col("a").alias("m"), F.col("m").alias("mm"))
        if parents.filter(F.col("n") > 1).isEmpty() and parents.join(above, "m", "left_semi").isEmpty():
            return parents.select(F.col("a").alias("node"), F.col("m").alias("root")).unionByName(
                parents.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())
        skipped = parents.join(above, "m", "left").select("a", F.coalesce("mm", "m").alias("b"))
        handed = current.join(parents.filter(F.col("n") > 1).select("a", "m"), "a").filter(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialize(skipped.unionByName(handed).distinct(), f"{label}-edges")
