"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node reachable) of an edge table with columns a
    and b; loops are allowed and make a node its own component.

    Each round hooks every node to its smallest neighbour, follows that once more, and
    contracts the edges. At least half of the nodes that still have edges go away in a
    round. Hubs are summed before the shuffle, and joins carry narrow rows only. Every round
    is written, so its lineage is cut and a lost executor costs a read.
    """
    # Kinds of nodes may be anything that Spark orders.
    labels = staged(edges.selectExpr("a AS node").union(edges.selectExpr("b")).distinct().withColumn("component", F.col("node")))
    rest = staged(edges.where("a <> b").distinct())
    while not rest.isEmpty():
        both = rest.select("a", "b").union(rest.select("b", "a"))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        hooked = staged(nearest.select("node", F.least("node", "other").alias("to")))
        onward = hooked.select(F.col("node").alias("to"), F.col("to").alias("further"))
        jumped = staged(hooked.join(onward, "to").select("node", F.col("further").alias("to")))
        labels = staged(
            labels.join(jumped.select(F.col("node").alias("component"), "to"), "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        )
        a = jumped.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        b = jumped.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        rest = rest.join(a, "a").join(b, "b").where("to_a <> to_b")
        rest = staged(rest.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    return labels
