"""Grouped duration reports and the grain/fan-out comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duration_by(star: DataFrame, keys: Sequence, measure: str = "duration_days",
                min_support: int = 0, count_name: str = "n_closed",
                avg_name: str = "avg_days", order: Sequence | None = None) -> DataFrame:
    """``count(*)`` and ``round(avg(measure), 1)`` per key combination.

    Open cases (NULL measure) are left out; groups with fewer than ``min_support``
    cases are dropped (HAVING). ``order`` sorts the (small) report; by default the
    keys ascending, NULLS LAST.
    """
    measured = star.filter(F.col(measure).isNotNull())
    report = measured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name),
        F.round(F.avg(measure), 1).alias(avg_name))
    if min_support:
        report = report.filter(F.col(count_name) >= min_support)
    if order is None:
        order = [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]
    return report.orderBy(*order) if order else report


def distinct_per(fact: DataFrame, key: str, other: str, measure: str | None = None,
                 count_name: str = "n_cases", distinct_name: str = "n_distinct") -> DataFrame:
    """Rows and exact distinct ``other`` values per ``key`` (is ``key`` unique alone?)."""
    df = fact if measure is None else fact.filter(F.col(measure).isNotNull())
    return (df.groupBy(key)
              .agg(F.count(F.lit(1)).alias(count_name),
                   F.count_distinct(other).alias(distinct_name))
              .orderBy(F.col(key).asc_nulls_last()))


def grain_mean(fact: DataFrame, measure: str = "duration_days",
               rows_name: str = "n_rows", mean_name: str = "mean_days") -> DataFrame:
    """Mean of the measure at the fact's own grain (one row)."""
    return (fact.filter(F.col(measure).isNotNull())
                .agg(F.count(F.lit(1)).alias(rows_name),
                     F.round(F.avg(measure), 1).alias(mean_name)))


def fanout_mean(fact: DataFrame, events: DataFrame, key: str, measure: str = "duration_days",
                rows_name: str = "n_rows", mean_name: str = "mean_days",
                events_key: str | None = None) -> DataFrame:
    """What ``avg(measure)`` becomes after joining the fact to a finer-grained table.

    Computed without materialising the fan-out: events are first counted per key
    (partial aggregation, so a key with millions of events costs one row per map
    task), then joined 1:1 to the fact. The joined row count is ``sum(n)`` and the
    fanned-out mean is ``sum(measure * n) / sum(n)`` — exactly the naive join's
    ``count(*)`` and ``avg``.
    """
    events_key = events_key or key
    per_key = events.groupBy(F.col(events_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    measured = fact.filter(F.col(measure).isNotNull()).select(F.col(key).alias("_k"), measure)
    joined = measured.join(per_key, "_k")
    total: Column = F.sum("_n")
    return joined.agg(
        F.coalesce(total, F.lit(0)).alias(rows_name),
        F.round(F.sum(F.col(measure) * F.col("_n")) / total, 1).alias(mean_name))


def grain_report(fact: DataFrame, events: DataFrame, key: str,
                 measure: str = "duration_days") -> DataFrame:
    """Grain mean next to the fan-out mean: rows and mean before and after the join.

    One aggregate over ``fact LEFT JOIN (events counted per key)``.
    """
    per_key = events.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    measured = fact.filter(F.col(measure).isNotNull()).select(F.col(key).alias("_k"), measure)
    joined = measured.join(per_key, "_k", "left")
    total = F.sum("_n")
    return joined.agg(
        F.count(F.lit(1)).alias("grain_rows"),
        F.round(F.avg(measure), 1).alias("grain_mean"),
        F.coalesce(total, F.lit(0)).alias("fanout_rows"),
        F.round(F.sum(F.col(measure) * F.col("_n")) / total, 1).alias("fanout_mean"))
