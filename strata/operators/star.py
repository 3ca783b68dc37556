"""Star-schema operators: fact build, dimension joins, role-playing calendar.

Join strategy. Dimensions whose size is bounded by construction (literal code tables)
may be broadcast explicitly. Every other dimension, the calendar too, is joined
declaratively: Catalyst broadcasts it when file statistics are under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans a sort-merge join into a
broadcast join at runtime when the materialised side turns out small — a size
check with the shuffle join as the fallback, never an unchecked broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import duration_days


@dataclass(frozen=True)
class Dim:
    """A dimension joined to the fact: ``fact[fact_key] == dim[dim_key]``."""
    df: DataFrame
    fact_key: str
    dim_key: str | None = None
    bounded: bool = False  # True when the size is bounded by construction

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.bounded else self.df


def semi_join(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is present in ``other`` (``IN (subquery)``)."""
    other_key = other_key or key
    keys = other.select(F.col(other_key).alias("_k")).distinct()
    return df.join(keys, df[key] == keys["_k"], "left_semi")


def anti_join(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` has no partner in ``other`` (NULL keys included)."""
    other_key = other_key or key
    keys = other.select(F.col(other_key).alias("_k")).distinct()
    return df.join(keys, df[key] == keys["_k"], "left_anti")


def build_fact(cases: DataFrame, district_dim: DataFrame, district_key: str,
               open_col: str, close_col: str, measure: str = "duration_days",
               dim_key: str | None = None) -> DataFrame:
    """Fact at case grain: cases with a known district plus the duration measure.

    Cases pointing at an unknown district are dropped (a relationships rule reports
    them); other foreign keys are not filtered.
    """
    known = semi_join(cases, district_dim, district_key, dim_key or district_key)
    return known.withColumn(measure, duration_days(open_col, close_col))


def star_join(fact: DataFrame, dims: Sequence) -> DataFrame:
    """Inner-join the fact to each dimension (the dimension key column is dropped).

    ``dims`` holds ``Dim`` objects or ``(df, fact_key, dim_key)`` tuples.
    """
    out = fact
    for dim in dims:
        if not isinstance(dim, Dim):
            dim = Dim(*dim)
        dim_key = dim.dim_key or dim.fact_key
        side = dim.side()
        if dim_key == dim.fact_key:
            out = out.join(side, on=dim.fact_key, how="inner")
        else:
            out = out.join(side, out[dim.fact_key] == side[dim_key], "inner").drop(side[dim_key])
    return out


def role_dim(calendar_df: DataFrame, role_col: str, date_col: str = "cal_date",
             prefix: str | None = None) -> Dim:
    """The calendar in one role (e.g. open date or close date).

    With ``prefix`` every calendar attribute is renamed ``<prefix>_<attr>`` so one
    fact can join the calendar in several roles.
    """
    cal = calendar_df
    if prefix:
        cal = cal.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cal.columns])
        date_col = f"{prefix}_{date_col}"
    return Dim(cal, role_col, date_col)
