"""De-duplication: whole-row distinct and one-survivor-per-key selection.

Survivor selection is written as a *grouped minimum over a struct* rather than a
``row_number()`` window: the aggregate combines map-side (partial aggregation),
so a key that holds a third of all rows is reduced inside every map task before
the shuffle instead of being sorted in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import INGESTED_AT
from strata.functions._util import as_col


def distinct_typed(df: DataFrame, exclude: Sequence[str] = (INGESTED_AT,)) -> DataFrame:
    """Whole-row DISTINCT over the typed projection (technical columns left out).

    Apply it after typing so ``11/03/2025`` and ``2025-03-11`` collapse.
    """
    keep = [c for c in df.columns if c not in set(exclude)]
    return df.select(*keep).distinct()


def _sort_fields(order: Sequence) -> list[Column]:
    """Encode ascending, NULLS LAST sort keys as struct fields."""
    fields: list[Column] = []
    for i, o in enumerate(order):
        col = as_col(o)
        fields.append(col.isNull().alias(f"_o{i}_null"))
        fields.append(col.alias(f"_o{i}"))
    return fields


def keep_preferred(df: DataFrame, key: str | Sequence[str], order: Sequence) -> DataFrame:
    """One row per ``key``: the first by ``order`` (each ascending, NULLS LAST).

    Equivalent to ``row_number() over (partition by key order by order...) = 1``.
    Add enough tie-break columns to ``order`` for a deterministic survivor; the
    remaining columns are appended as the final tie-break automatically.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    tiebreak = list(order) + [F.col(c) for c in payload]
    # Exact copies go first: a distinct hashes, while a minimum over text sorts its rows.
    df = df.distinct()
    best = F.min(F.struct(*_sort_fields(tiebreak), *[F.col(c).alias(f"_p_{c}") for c in payload]))
    out = df.groupBy(*keys).agg(best.alias("_best"))
    return out.select(*keys, *[F.col(f"_best._p_{c}").alias(c) for c in payload]).select(*df.columns)


def keep_any(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``DISTINCT ON (key)``: one row per key, deterministically the smallest."""
    return keep_preferred(df, key, [])


def prefer_not_shouting(label) -> list[Column]:
    """Sort keys preferring a label that is not all upper case, then the label."""
    col = as_col(label)
    return [col == F.upper(col), col]
