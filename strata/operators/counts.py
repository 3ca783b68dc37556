"""Row-count report over several tables (one result DataFrame)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "n_rows") -> DataFrame:
    """``(table_name, n_rows)`` per table: a union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
               .select(F.lit(name).alias(name_col), F.col(count_col))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
