"""Misspelt labels: distinct labels within a small edit distance, grouped into clusters.

Labels are compared through their bigrams (with padding, numbered when they repeat). Each
edit touches at most two of them, so two labels within distance d share one of their 2 d + 1
rarest bigrams: labels meet only on those (prefix filter), and the edit distance settles
what meets. No label is compared with all others, and a bigram that a third of all labels
hold is in nobody's prefix unless the label has no rarer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.components import components

#: Labels of at least so many characters may differ by two edits, shorter ones by one.
LONG = 8
#: Shorter labels are taken as they are.
SHORTEST = 3


def allowed(a, b):
    """Edits between two labels that count as one spelling."""
    return F.when(F.greatest(F.length(a), F.length(b)) >= LONG, F.lit(2)).otherwise(F.lit(1))


def _prefixes(labels: DataFrame) -> DataFrame:
    """``(label, gram)``: the rarest bigrams of every label, as many as the filter asks for."""
    padded = F.concat(F.lit("\u0002"), "label", F.lit("\u0003"))
    grams = F.transform(F.sequence(F.lit(1), F.length("label") + 1), lambda i: F.substr(padded, i, F.lit(2)))
    each = labels.select("label", F.explode(grams).alias("g")).groupBy("label", "g").agg(F.count(F.lit(1)).alias("times"))
    each = each.select("label", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")),
                                                      lambda k: F.concat("g", k.cast("string")))).alias("gram"))
    df = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # a label's bigrams are as many as its characters, so its window is small
    rank = F.row_number().over(Window.partitionBy("label").orderBy("df", "gram"))
    need = F.when(F.length("label") >= LONG - 2, F.lit(5)).otherwise(F.lit(3))
    return each.join(df, "gram").withColumn("_r", rank).filter(F.col("_r") <= need).select("label", "gram")


def similar_labels(labels: DataFrame) -> DataFrame:
    """``(a, b, distance)``, a < b: distinct labels of ``(label)`` within the allowed distance,
    all such pairs. Labels differ by case if written so; fold them before, if that is no
    difference."""
    own = labels.select("label").filter(F.col("label").isNotNull() & (F.length("label") >= SHORTEST)).distinct()
    p = _prefixes(own)
    left, right = p.select(F.col("label").alias("a"), "gram"), p.select(F.col("label").alias("b"), "gram")
    near = left.join(right, "gram").filter((F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= allowed("a", "b")))
    pairs = near.select("a", "b").distinct().withColumn("distance", F.levenshtein("a", "b"))
    return pairs.filter(F.col("distance") <= allowed("a", "b"))


def spelling_clusters(df: DataFrame, label: str) -> DataFrame:
    """``(cluster, label, n_rows, n_labels)``: labels that chains of similar labels connect,
    with the rows of each; ``cluster`` is the most frequent label (of ties the smallest).
    Labels without a similar one are left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    found = components(similar_labels(counts), "a", "b").withColumnRenamed("node", "label")
    rows = found.join(counts, "label")
    best = rows.groupBy("component").agg(F.min(F.struct((-F.col("n_rows")).alias("n"), "label")).alias("m"), F.count(F.lit(1)).alias("n_labels"))
    return rows.join(best, "component").select(F.col("m.label").alias("cluster"), "label", "n_rows", "n_labels")
