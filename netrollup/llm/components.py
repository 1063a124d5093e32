"""Connected components by contraction.

In each round every node takes the least of itself and its neighbours, follows that label once
more, and edges are rewritten to the labels; what connects equal labels falls away.  A component
shrinks at least by half a round.  Rounds are written to the shared folder, so their cost and
lineage do not add up, and the driver sees nothing but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrollup.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its least
    node.  Nodes may be of any type with an order; edges with a null are left out."""
    left = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct(), "cc-edges")
    labels = None
    while not left.isEmpty():
        least = staged(
            left.select(F.col("b").alias("node"), F.col("a").alias("to"))
            .unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("to")))
            .groupBy("node").agg(F.min("to").alias("to")), "cc-least")
        # Follow the label once more; labels of labels are in the same table.
        jumped = staged(
            least.join(least.select(F.col("node").alias("n"), F.col("to").alias("t")),
                       F.col("to") == F.col("n"))
            .select("node", F.col("t").alias("to")), "cc-jump")
        labels = jumped if labels is None else staged(
            labels.join(jumped.select(F.col("node").alias("n"), F.col("to").alias("t")),
                        F.col("to") == F.col("n"), "left")
            .select("node", F.coalesce("t", "to").alias("to")), "cc-labels")
        to_a = jumped.select(F.col("node").alias("na"), F.col("to").alias("ta"))
        to_b = jumped.select(F.col("node").alias("nb"), F.col("to").alias("tb"))
        left = staged(
            left.join(to_a, F.col("a") == F.col("na")).join(to_b, F.col("b") == F.col("nb"))
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .where("a != b").distinct(), "cc-edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("to").alias("component"))
