"""Connected components of an edge table, labelled with the smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, comp)`` for every endpoint: ``comp`` is the smallest id reachable.

    Each round a node takes the smallest of: its own label, its label's label, and the
    label's label of its neighbours; and it offers the last to the node that its label
    names (hooking), so long chains fold in a logarithmic number of rounds. A round is
    two joins and one partial-aggregated minimum; its result is written, which cuts the
    lineage. Only a count of changed rows reaches the driver.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = written(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
                   .distinct(), "cc-edges")
    f = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("f"))
    f = written(f, "cc-labels")
    while True:
        g = f.join(f.select(F.col("u").alias("f"), F.col("f").alias("g")), "f")  # u, f, g=f(f)
        near = (both.join(g.select(F.col("u").alias("v"), F.col("g").alias("gv")), "v")
                    .groupBy("u").agg(F.min("gv").alias("m")))
        offers = (g.join(near, "u")
                   .select(F.explode(F.array(
                       F.struct(F.col("u"), F.least("f", "g", "m").alias("f"), F.col("f").alias("was")),
                       F.struct(F.col("f").alias("u"), F.least("g", "m").alias("f"),
                                F.lit(None).cast("long").alias("was")))).alias("o"))
                   .groupBy(F.col("o.u").alias("u")).agg(F.min("o.f").alias("f"), F.max("o.was").alias("was")))
        nxt = written(offers, "cc-labels")
        f = nxt.select("u", "f")
        if not nxt.filter("f <> was").limit(1).count():
            return f.select(F.col("u").alias("id"), F.col("f").alias("comp"))
