"""Date helpers: duration measure and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import PT_MONTH_NAMES
from strata.functions._util import as_col


def duration_days(open_date, close_date) -> Column:
    """Whole days from open to close; NULL while open or when close < open.

    Arguments are dates (cast a timestamp with ``to_date`` first so the count is
    of calendar-day boundaries, not 24-hour periods).
    """
    o, c = as_col(open_date), as_col(close_date)
    return F.when(c.isNotNull() & (c >= o), F.datediff(c, o).cast("bigint"))


def month_name(d, names=PT_MONTH_NAMES) -> Column:
    """Name of the month from a fixed 12-entry list (1-based)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.month(as_col(d)))


def is_weekend(d) -> Column:
    """Saturday or Sunday (``weekday`` is Monday=0 … Sunday=6)."""
    return F.weekday(as_col(d)).isin(5, 6)

