"""Duration reports over the gold star schema and over the normalised model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import CLOSURE_DESCRIPTION
from strata.functions import court_label
from strata.operators.events import first_event_by_code
from strata.operators.measures import distinct_per, duration_by, fanout_mean, grain_mean, grain_report
from strata.operators.star import Dim, role_dim, star_join
from strata.plans.normalise import Normalised

Gold = Mapping[str, DataFrame]


def star(gold: Gold, district: bool = True, klass: bool = False, role: str | None = "opened",
         prefix: str | None = None) -> DataFrame:
    """The fact joined to the requested dimensions; ``role`` picks the date column
    the calendar plays (open or close date)."""
    dims = []
    if district:
        dims.append(Dim(gold["dim_district"], "district_id"))
    if klass:
        dims.append(Dim(gold["dim_class"], "class_id"))
    if role:
        dims.append(role_dim(gold["dim_calendar"], role, prefix=prefix))
    return star_join(gold["fact_cases"], dims)


def by_district_class_year(gold: Gold, role: str = "opened") -> DataFrame:
    """Mean duration by district, class and year of the ``role`` date."""
    return duration_by(star(gold, klass=True, role=role),
                       ["district_name", "class_name", "cal_year"])


def by_district_year(gold: Gold) -> DataFrame:
    return duration_by(star(gold), ["district_name", "cal_year"])


def by_court(gold: Gold, min_support: int = 3) -> DataFrame:
    """By district and court (a court number is only unique inside its district);
    groups under ``min_support`` cases are dropped; slowest first."""
    return duration_by(star(gold, role=None), ["district_name", "court_id"],
                       min_support=min_support,
                       order=[F.col("avg_days").desc_nulls_last(),
                              F.col("district_name").asc_nulls_last(),
                              F.col("court_id").asc_nulls_last()])


def court_key_not_unique(gold: Gold) -> DataFrame:
    """Cases and distinct districts per court number (measured cases only)."""
    return distinct_per(gold["fact_cases"], "court_id", "district_id", "duration_days",
                        "n_cases", "n_districts")


def grain(gold: Gold) -> DataFrame:
    return grain_mean(gold["fact_cases"])


def fanout(gold: Gold, events: DataFrame) -> DataFrame:
    return fanout_mean(gold["fact_cases"], events, "case_id")


def grain_vs_fanout(gold: Gold, events: DataFrame) -> DataFrame:
    return grain_report(gold["fact_cases"], events, "case_id")


def close_role_by_year(gold: Gold) -> DataFrame:
    """Mean duration by the year cases *closed* (calendar in the close-date role)."""
    return duration_by(star(gold, district=False, role="closed"), ["cal_year"])


def first_closure(norm: Normalised) -> DataFrame:
    """First closing event per case, the closing type named in the code table."""
    return first_event_by_code(norm.movimentacao, norm.tipo_movimento, "case_id", "event_date",
                               "event_type_id", "event_type_id", "description",
                               CLOSURE_DESCRIPTION, "closed")


def duration_from_events(norm: Normalised, min_support: int = 3) -> DataFrame:
    """The by-court question answered on the normalised model: closing is an event,
    the district is reached through the court."""
    cases = (norm.processo.select("case_id", "court_id", "opened")
             .join(norm.vara.select("court_id", "district_id", "court_name"), "court_id")
             .join(norm.comarca.select("district_id", "district_name"), "district_id")
             .join(first_closure(norm), "case_id")
             .filter(F.col("opened").isNotNull() & (F.col("closed") >= F.col("opened")))
             .withColumn("duration_days", F.datediff("closed", "opened").cast("bigint")))
    return duration_by(cases, ["district_name", "court_name"], min_support=min_support,
                       order=[F.col("avg_days").desc_nulls_last(),
                              F.col("district_name").asc_nulls_last(),
                              F.col("court_name").asc_nulls_last()])


def events_equal_gold(gold: Gold, norm: Normalised, min_support: int = 3) -> DataFrame:
    """Rows only in the gold answer and rows only in the event answer (both 0 when
    the two paths agree), as multiset differences (``EXCEPT ALL``) both ways.

    One pass: the two answers are tagged, unioned and counted per full row (NULLs
    compare equal, as in ``EXCEPT ALL``); each side is computed once.
    """
    cols = ["district_name", "court_name", "n_closed", "avg_days"]
    g = by_court(gold, min_support).select(
        "district_name", court_label("court_id").alias("court_name"), "n_closed", "avg_days")
    e = duration_from_events(norm, min_support).select(*cols)
    tagged = (g.select(*cols, F.lit(1).alias("_g"), F.lit(0).alias("_e"))
              .unionByName(e.select(*cols, F.lit(0).alias("_g"), F.lit(1).alias("_e"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("_g").alias("_cg"), F.sum("_e").alias("_ce"))
    extra = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    return per_row.agg(
        F.coalesce(F.sum(extra("_cg", "_ce")), F.lit(0)).cast("bigint").alias("only_in_gold"),
        F.coalesce(F.sum(extra("_ce", "_cg")), F.lit(0)).cast("bigint").alias("only_in_events"))
