"""Serving gold to SQL consumers: tables as views, the duration questions as SQL.

Consumers of the gold layer only group; the measure and every cleaning decision
already live in the tables. Catalyst plans these exactly like the DataFrame
reports in ``strata.plans.reports`` (same broadcasts, same partial aggregates).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

GOLD_VIEWS = ("fact_cases", "dim_district", "dim_class", "dim_calendar", "stg_events")
NORMALISED_VIEWS = ("comarca", "vara", "processo", "movimentacao", "tipo_movimento")

@dataclass(frozen=True)
class Report:
    """A duration question: group keys, the date role, support, and what to show."""

    keys: tuple[str, ...] = ()
    role: str | None = None           # date column the calendar plays
    slowest_first: bool = False
    support: bool = False             # drop groups below the minimum support
    distinct: str | None = None       # count distinct values of this instead of averaging
    per_event: bool = False           # weigh each case by its events (the fan-out grain)


#: Where a key comes from: (view, its key, the fact's column).
KEY_HOME = {"district_name": ("dim_district", "district_id", "district_id"),
            "class_name": ("dim_class", "class_id", "class_id"), "cal_year": ("dim_calendar", "cal_date", None)}

REPORTS = {
    "by_district_class_year": Report(("district_name", "class_name", "cal_year"), "opened"),
    "by_district_year": Report(("district_name", "cal_year"), "opened"),
    "by_court": Report(("district_name", "court_id"), slowest_first=True, support=True),
    "court_key_not_unique": Report(("court_id",), distinct="district_id"),
    "grain_mean": Report(),
    "fanout_mean": Report(per_event=True),
}


def report_sql(r: Report, prefix: str = "", min_support: int = 3) -> str:
    """The report as SQL over the served views. NULL keys sort last; ties by the keys."""
    source = f"{prefix}fact_cases"
    weight = ""
    if r.per_event:
        # events are counted per case first, so the fan-out is never materialised
        source += (f" join (select case_id as event_case, count(*) as n_events from {prefix}stg_events"
                   " group by case_id) on case_id = event_case")
        weight = " * n_events"
    for k in r.keys:
        if k in KEY_HOME:
            view, key, column = KEY_HOME[k]
            source += f" join (select {key} as {k}_key, {k} from {prefix}{view}) on {column or r.role} = {k}_key"
    total = "sum(n_events)" if r.per_event else "count(*)"
    if r.distinct:
        shown = f"{total} as n_cases, count(distinct {r.distinct}) as n_{r.distinct.removesuffix('_id')}s"
    else:
        names = ("n_closed", "avg_days") if r.keys else ("n_rows", "mean_days")
        mean = f"sum(duration_days{weight}) / {total}" if r.per_event else "avg(duration_days)"
        shown = f"{total} as {names[0]}, round({mean}, 1) as {names[1]}"
    sql = f"select {''.join(k + ', ' for k in r.keys)}{shown} from {source} where duration_days is not null"
    if not r.keys:
        return sql
    order = [f"{k} nulls last" for k in r.keys]
    if r.slowest_first:
        order.insert(0, "avg_days desc nulls last")
    having = f" having {total} >= {int(min_support)}" if r.support else ""
    return f"{sql} group by {', '.join(r.keys)}{having} order by {', '.join(order)}"


def event_model_sql(prefix: str, min_support: int, closing: str) -> str:
    """The by-court question on the event-sourced model: a case is closed by its first
    event of the closing type, and its district is that of its court."""
    code = closing.replace("'", "''")
    closed = (f"select case_id as closed_case, min(event_date) as closed from {prefix}movimentacao left semi join "
              f"(select event_type_id as code from {prefix}tipo_movimento where description = '{code}') "
              "on event_type_id = code group by case_id")
    place = (f"select court_id as place, district_name, court_name from {prefix}vara "
             f"join (select district_id as home, district_name from {prefix}comarca) on district_id = home")
    days = (f"select district_name, court_name, datediff(closed, opened) as days from {prefix}processo "
            f"join ({place}) on court_id = place join ({closed}) on case_id = closed_case")
    return (f"select district_name, court_name, count(*) as n_closed, round(avg(days), 1) as avg_days from ({days}) "
            f"where days >= 0 group by district_name, court_name having count(*) >= {int(min_support)} "
            "order by avg_days desc nulls last, district_name nulls last, court_name nulls last")


def serve_views(tables: Mapping[str, DataFrame], prefix: str = "",
                names=GOLD_VIEWS) -> list[str]:
    """Register the gold tables as temporary views ``<prefix><name>``."""
    registered = []
    for name in names:
        tables[name].createOrReplaceTempView(f"{prefix}{name}")
        registered.append(f"{prefix}{name}")
    return registered


def serve_normalised_views(norm, prefix: str = "") -> list[str]:
    """Register the event-sourced tables as temporary views."""
    return serve_views({name: getattr(norm, name) for name in NORMALISED_VIEWS}, prefix,
                       NORMALISED_VIEWS)


def run_event_model_report(spark: SparkSession, prefix: str = "", min_support: int = 3) -> DataFrame:
    from strata.constants import CLOSURE_DESCRIPTION

    return spark.sql(event_model_sql(prefix, min_support, CLOSURE_DESCRIPTION))


def run_report(spark: SparkSession, report: str, prefix: str = "", min_support: int = 3) -> DataFrame:
    """One of ``REPORTS`` over views registered with ``serve_views``."""
    return spark.sql(report_sql(REPORTS[report], prefix, min_support))
