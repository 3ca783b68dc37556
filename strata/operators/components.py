"""Connected components of a graph given as pairs, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of all nodes that occur in pairs; a component is named by its
    smallest node.

    Every node takes the smallest name among its neighbours and itself, then the name that
    its name has taken meanwhile, so distances shrink by half a round. A node with very many
    neighbours is reduced map-side. Each round is checkpointed; rounds end when no name
    changes.
    """
    spark = pairs.sparkSession
    ensure_checkpoint_dir(spark)
    both = pairs.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct().checkpoint()
    names = edges.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("c")).checkpoint()
    while True:
        near = edges.join(names.select(F.col("x").alias("y"), "c"), "y").groupBy("x").agg(F.min("c").alias("m"))
        step = names.join(near, "x").select("x", F.col("c").alias("was"), F.least("c", "m").alias("c"))
        jump = step.select(F.col("x").alias("c"), F.col("c").alias("far"))
        now = step.join(jump, "c", "left").select("x", "was", F.least("c", F.coalesce("far", "c")).alias("c")).checkpoint()
        if not now.filter("c <> was").limit(1).count():
            return now.select(F.col("x").alias("node"), F.col("c").alias("component"))
        names = now.select("x", "c")
