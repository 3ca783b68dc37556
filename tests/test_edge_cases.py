"""Edge cases: empty input, all-open cases, calendar bounds, several closings."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import calendar, first_event
from strata.operators import quality as Q
from strata.plans import medallion as M
from strata.plans import reports as R

D = dt.date
CASE_COLS = "case_id string, class_id string, district_id string, court_id string, " \
            "opened string, closed string, status string"


def bronze(spark, cases, districts=(("1", "A", "ms"),), classes=(("1", "X"),), events=()):
    return {
        "cases": spark.createDataFrame(list(cases), CASE_COLS),
        "districts": spark.createDataFrame(list(districts),
                                           "district_id string, district_name string, uf string"),
        "classes": spark.createDataFrame(list(classes), "class_id string, class_name string"),
        "events": spark.createDataFrame(list(events),
                                        "case_id string, event_type string, event_date string"),
    }


def test_empty_tables_flow_through(spark):
    t = M.medallion(bronze(spark, [], districts=[], classes=[]))
    assert t["fact_cases"].count() == 0
    assert t["dim_calendar"].count() == 0
    assert R.by_district_class_year(t).count() == 0
    g = R.grain(t).collect()[0]
    assert (g.n_rows, g.mean_days) == (0, None)
    q = Q.run_suite(t, [Q.not_null("fact_cases", "case_id"), Q.unique("fact_cases", "case_id")])
    assert all(r.passed for r in q.collect())


def test_all_open_cases_calendar_runs_to_today(spark):
    cases = [("1", "1", "1", "1", "2024-01-01", None, "Em andamento")]
    t = M.medallion(bronze(spark, cases), today=D(2024, 1, 10))
    assert t["dim_calendar"].count() == 10
    assert t["fact_cases"].collect()[0].duration_days is None


def test_open_after_every_close_falls_outside_calendar(spark):
    cases = [("1", "1", "1", "1", "2024-01-01", "2024-01-05", "Baixado"),
             ("2", "1", "1", "1", "2024-02-01", "2024-03-01", "Baixado"),
             ("3", "1", "1", "1", "2024-04-01", None, "Em andamento")]
    t = M.medallion(bronze(spark, cases))
    cal = t["dim_calendar"].agg(F.min("cal_date"), F.max("cal_date")).collect()[0]
    assert tuple(cal) == (D(2024, 1, 1), D(2024, 3, 1))
    # open cases are unmeasured anyway; both closed cases are reported
    assert sum(r.n_closed for r in R.by_district_year(t).collect()) == 2
    greatest = calendar(t["stg_cases"], "opened", "closed", bounds="greatest")
    assert greatest.agg(F.max("cal_date")).collect()[0][0] == D(2024, 4, 1)


def test_several_closing_events_first_wins(spark):
    ev = spark.createDataFrame([(1, 7, D(2024, 5, 1)), (1, 7, D(2024, 3, 1)), (1, 1, D(2024, 1, 1))],
                               "case_id long, t int, d date")
    assert first_event(ev, "case_id", "d", "t", 7, "closed").collect()[0].closed == D(2024, 3, 1)


def test_same_court_number_in_several_districts(spark):
    cases = [("1", "1", "1", "2", "2024-01-01", "2024-01-11", "Baixado"),
             ("2", "1", "2", "2", "2024-01-01", "2024-01-21", "Baixado")]
    t = M.medallion(bronze(spark, cases, districts=[("1", "a", "x"), ("2", "b", "y")]))
    row = R.court_key_not_unique(t).collect()[0]
    assert (row.court_id, row.n_cases, row.n_districts) == (2, 2, 2)
    assert R.by_court(t, min_support=1).count() == 2     # grouped with the district
