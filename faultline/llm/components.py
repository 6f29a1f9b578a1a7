"""Connected components of a graph given as edges, by contracting it round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.settle import settle


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Each round hooks every node to its smallest neighbour, follows these pointers to their
    roots in steps that double, and keeps only edges between different trees: a star or a
    chain is done in one round, and any graph loses at least half of its nodes. Nodes without
    edges are not in the result; loops and repeated edges do no harm. All state is in
    checkpoints, nothing is collected.
    """
    left = settle(edges.select("a", "b").where("a <> b").distinct())
    labels = settle(
        left.select(F.explode(F.array("a", "b")).alias("node"))
        .distinct()
        .withColumn("component", F.col("node"))
    )
    for _ in range(rounds):
        if left.isEmpty():
            return labels
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = settle(
            both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("up"))
        )
        while True:  # follow the pointers until each node has the root of its tree
            above = hooks.select(F.col("a").alias("up"), F.col("up").alias("top"))
            jumped = settle(
                hooks.join(above, "up", "left").select(
                    "a",
                    F.coalesce("top", "up").alias("up"),
                    (F.coalesce("top", "up") != F.col("up")).alias("moved"),
                )
            )
            hooks = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        labels = settle(
            labels.join(hooks, labels["component"] == hooks["a"], "left").select(
                "node", F.coalesce("up", "component").alias("component")
            )
        )
        at_a = hooks.select("a", F.col("up").alias("ua"))
        at_b = hooks.select(F.col("a").alias("b"), F.col("up").alias("ub"))
        left = settle(
            left.join(at_a, "a")
            .join(at_b, "b")
            .select(F.col("ua").alias("a"), F.col("ub").alias("b"))
            .where("a <> b")
            .distinct()
        )
    raise RuntimeError(f"components did not settle in {rounds} rounds")
