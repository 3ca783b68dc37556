"""Reports kept up to date from batches of changed rows.

The state of a report is one row per group: how many rows count and the sum of their measure.
A batch adds its rows and takes back what the same keys said before; both are signed rows, so
a batch becomes a small state of its own and states are added. Sums of whole numbers are
exact in any order, so the state after any batches equals the one over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


def signed_changes(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch's rows with sign 1, and the current rows of its keys with sign -1.

    ``batch`` holds one row per key; keys it does not name are untouched. A key that is to go
    is named by a row whose measure is null.
    """
    keys = batch.select(F.col(key).alias("_k"))
    old = current.join(keys, current[key].eqNullSafe(keys["_k"]), "left_semi")
    return batch.withColumn(SIGN, F.lit(1)).unionByName(old.withColumn(SIGN, F.lit(-1)))


def group_state(rows: DataFrame, groups: Sequence, measure: str) -> DataFrame:
    """``(groups, n, total)``: signed count and sum of the non-null measures; rows without a
    sign count as added. Whole-number measures only: a sum of floats would drift."""
    kind = rows.schema[measure].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "decimal"):
        raise TypeError(f"{measure} is {kind}; a state needs whole numbers")
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    return rows.filter(F.col(measure).isNotNull()).groupBy(*groups).agg(
        F.sum(sign).cast("bigint").alias("n"), F.sum(sign * F.col(measure)).alias("total"))


def add_states(*states: DataFrame) -> DataFrame:
    """The sum of states; groups that nothing is left of go."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    groups = [c for c in every.columns if c not in ("n", "total")]
    return (every.groupBy(*groups).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
                 .filter((F.col("n") != 0) | (F.col("total") != 0)))


def report(state: DataFrame, n: str = "n_closed", mean: str = "avg_days") -> DataFrame:
    """Count and mean (one decimal) per group."""
    groups = [c for c in state.columns if c not in ("n", "total")]
    return state.filter("n > 0").select(*groups, F.col("n").alias(n), F.round(F.col("total") / F.col("n"), 1).alias(mean))
