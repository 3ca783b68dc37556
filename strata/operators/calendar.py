"""Generated calendar dimension (role-playing date dimension)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import PT_MONTH_NAMES
from strata.functions.dates import is_weekend, month_name


def calendar_bounds(cases: DataFrame, open_col: str, close_col: str,
                    today: _dt.date | str | None = None, bounds: str = "reference") -> DataFrame:
    """One-row frame ``(lo, hi)``.

    ``reference``: lo = min(open), hi = coalesce(max(close), today) — a case opened
    after the last close date falls outside the calendar. ``greatest``: hi also
    covers max(open).
    """
    today_col = F.current_date() if today is None else F.lit(today).cast("date")
    hi = F.coalesce(F.max(close_col), today_col)
    if bounds == "greatest":
        hi = F.greatest(hi, F.max(open_col))
    elif bounds != "reference":
        raise ValueError(f"unknown bounds {bounds!r}")
    return cases.agg(F.min(open_col).alias("lo"), hi.alias("hi"))


def calendar(cases: DataFrame, open_col: str, close_col: str, today=None,
             month_names=PT_MONTH_NAMES, bounds: str = "reference",
             date_col: str = "cal_date") -> DataFrame:
    """Every day between the bounds (inclusive) with its attributes.

    The bounds come from a global aggregate (partial per task); nothing is collected. They
    are expanded to years, the years are spread over tasks, and each task expands its years
    to days: one mistyped year (``12025``) makes a long calendar, not a huge row. No size
    is assumed: joins choose by statistics.
    """
    spark = cases.sparkSession
    years = (calendar_bounds(cases, open_col, close_col, today, bounds)
             .select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("_y")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.make_date("_y", F.lit(1), F.lit(1))
    last = F.make_date("_y", F.lit(12), F.lit(31))
    days = (years.repartition(n, "_y")
                 .select(F.explode(F.sequence(F.greatest("lo", first), F.least("hi", last))).alias(date_col)))
    d = F.col(date_col)
    return days.select(
        d,
        F.year(d).cast("bigint").alias("cal_year"),
        F.month(d).cast("bigint").alias("cal_month"),
        month_name(d, month_names).alias("month_name"),
        F.quarter(d).cast("bigint").alias("cal_quarter"),
        is_weekend(d).alias("is_weekend"),
    )
