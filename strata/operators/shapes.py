"""Formats nobody listed: the shapes that a column's values have, and how many each.

A value's shape shows upper-case letters as A, lower-case ones as a, digits as 9, runs as
one; other characters stay. A column of free text has as many shapes as values, so shapes are
not grouped outright: every task keeps a bounded summary of its own (the rarest counts are
decremented away, with the loss noted), summaries add up, and the few shapes that may reach
the wanted share are then counted exactly over all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shape(c: Column) -> Column:
    """``'AB-123 x'`` -> ``'A-9 a'`` (ASCII letters and digits; null stays null)."""
    out = F.regexp_replace(c, "[A-Z]+", "A")
    out = F.regexp_replace(out, "[a-z]+", "a")
    return F.regexp_replace(out, "[0-9]+", "9")


def summaries(values: DataFrame, keep: int) -> DataFrame:
    """Of ``(column_name, shape)`` rows: ``(column_name, shape, n, lost)``, at most ``keep``
    shapes a column and task, whose count is too low by ``lost`` at most. A null shape
    carries a column's total and loss."""
    def run(batches):
        seen: dict[str, Counter] = {}
        total: Counter = Counter()
        lost: Counter = Counter()
        for b in batches:
            both = pa.table([b.column(0), b.column(1)], ["c", "s"]).group_by(["c", "s"]).aggregate([([], "count_all")])
            for c, s, n in zip(*(both.column(k).to_pylist() for k in ("c", "s", "count_all"))):
                own = seen.setdefault(c, Counter())
                own[s] += n
                total[c] += n
                if len(own) > 2 * keep:
                    # what the rarest half counts at most is taken from all
                    cut = sorted(own.values(), reverse=True)[keep]
                    lost[c] += cut
                    seen[c] = Counter({k: v - cut for k, v in own.items() if v > cut})
        rows = [(c, s, n, 0) for c, own in seen.items() for s, n in own.items()] + [(c, None, total[c], lost[c]) for c in total]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             ["column_name", "shape", "n", "lost"])

    return values.mapInArrow(run, "column_name string, shape string, n long, lost long")


def frequent_shapes(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.01, keep: int = 1000) -> DataFrame:
    """``(column_name, shape, n, n_values)``: every shape that at least ``share`` of a column's
    non-null values have, with its exact count. ``keep`` must exceed ``1 / share``."""
    if keep * share <= 1:
        raise ValueError("keep must exceed 1 / share")
    columns = list(columns or df.columns)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), shape(F.col(f"`{c}`").cast("string")).alias("shape")) for c in columns]))
    values = df.select(cells.alias("x")).select("x.*").filter("shape is not null")
    told = summaries(values, keep)
    added = told.groupBy("column_name", "shape").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost"))
    totals = added.filter("shape is null").select("column_name", F.col("n").alias("n_values"), "lost")
    # at most about 2 / share shapes a column can pass
    maybe = (added.filter("shape is not null").drop("lost").join(totals, "column_name")
                  .filter(F.col("n") + F.col("lost") >= share * F.col("n_values")).select("column_name", "shape", "n_values"))
    exact = values.join(F.broadcast(maybe), ["column_name", "shape"]).groupBy("column_name", "shape", "n_values").agg(F.count(F.lit(1)).alias("n"))
    return exact.filter(F.col("n") >= share * F.col("n_values")).select("column_name", "shape", "n", "n_values")
