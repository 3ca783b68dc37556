"""End-to-end on a small hand-written extract with every planted defect.

Expected values are computed here by brute force in plain Python.
"""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import reports as R
from strata.plans.lakehouse import build_lakehouse
from strata.plans.normalise import normalise
from tests.conftest import FIXTURES

D = dt.date
MEASURED = {  # case -> (open, close) for closed cases with close >= open, known district
    100001: (D(2020, 1, 10), D(2021, 1, 9)), 100003: (D(2020, 3, 5), D(2020, 6, 3)),
    100004: (D(2020, 4, 1), D(2021, 2, 1)), 100008: (D(2021, 3, 1), D(2027, 12, 31)),
    100009: (D(2020, 1, 20), D(2020, 3, 20)), 100010: (D(2020, 1, 11), D(2020, 12, 31)),
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    sources = {"cases": ("csv", os.path.join(FIXTURES, "cases.csv")),
               "districts": ("csv", os.path.join(FIXTURES, "districts.csv")),
               "classes": ("csv", os.path.join(FIXTURES, "classes.csv")),
               "events": ("json", os.path.join(FIXTURES, "events.json"))}
    return build_lakehouse(spark, sources, root)


def test_bronze_counts(lake):
    assert {k: v.rows for k, v in lake.bronze.items()} == \
        {"cases": 12, "districts": 3, "classes": 4, "events": 7}


def test_silver(lake):
    t = lake.tables
    cases = {r.case_id: r for r in t["stg_cases"].collect()}
    assert len(cases) == t["stg_cases"].count() == 10       # duplicate collapsed, no-id dropped
    assert cases[100003].opened == D(2020, 3, 5)             # day-first date parsed
    assert cases[100004].closed == D(2021, 2, 1)
    assert cases[100009].case_id == 100009                   # '100009.0'
    assert cases[100011].opened is None                      # 'NA' token
    names = dict(t["stg_districts"].select("district_id", "district_name").collect())
    assert names == {1: "Porto Claro", 2: "Serra Alta", 3: "Vale-do Rio D'ouro"}
    assert {r.uf for r in t["stg_districts"].collect()} == {"MS"}
    assert dict(t["stg_classes"].collect())[2] == "Cobrança Estadual"
    assert t["stg_classes"].count() == 3
    assert t["stg_events"].count() == 6                      # same event, two date formats


def test_gold_fact_and_calendar(lake):
    t = lake.tables
    fact = {r.case_id: r.duration_days for r in t["fact_cases"].collect()}
    assert 100006 not in fact                                 # orphan district dropped
    assert len(fact) == 9
    assert {k: v for k, v in fact.items() if v is not None} == \
        {k: (c - o).days for k, (o, c) in MEASURED.items()}
    assert fact[100007] is None and fact[100002] is None      # negative, open
    cal = t["dim_calendar"]
    assert cal.count() == (D(2027, 12, 31) - D(2020, 1, 10)).days + 1
    weekend = sum(1 for i in range(cal.count())
                  if (D(2020, 1, 10) + dt.timedelta(i)).isoweekday() in (6, 7))
    assert cal.filter("is_weekend").count() == weekend


def test_quality_report(lake):
    q = {(r.table_name, r.column_name, r.rule): r.violations for r in lake.quality.collect()}
    assert len(q) == 20
    assert q[("stg_cases", "opened", "not_null")] == 1        # the 'NA' open date
    assert q[("stg_events", "case_id", "not_null")] == 1      # kept, reported
    assert sum(q.values()) == 2


def test_reports(lake):
    t = lake.tables
    grain = R.grain(t).collect()[0]
    days = [(c - o).days for o, c in MEASURED.values()]
    assert grain.n_rows == 6 and grain.mean_days == round(sum(days) / 6, 1)
    fan = R.fanout(t, t["stg_events"]).collect()[0]
    assert (fan.n_rows, fan.mean_days) == (5, 253.0)
    assert fan.mean_days != grain.mean_days
    by_court = R.by_court(t, min_support=1).collect()
    assert sum(r.n_closed for r in by_court) == 6
    flagship = R.by_district_class_year(t).collect()
    assert sum(r.n_closed for r in flagship) == 6
    nu = {r.court_id: (r.n_cases, r.n_districts) for r in R.court_key_not_unique(t).collect()}
    assert nu[1] == (5, 3)   # 100001, 100003, 100008, 100009, 100010


def test_normalised_model_agrees_with_gold(spark, lake):
    b = {k: v.bronze.drop("_ingerido_em") for k, v in lake.bronze.items()}
    norm = normalise(b["cases"], b["districts"], b["classes"])
    counts = dict(norm.counts.collect())
    assert counts["vara"] == 15 and counts["comarca"] == 3 and counts["situacao"] == 2
    assert counts["tipo_movimento"] == 7 and counts["classe"] == 3
    assert counts["processo"] == 9
    # proc_raw keeps the duplicate of 100003: 10 rows, 9 closed (2 of them for 100003)
    assert counts["movimentacao"] == 10 + 10 + 9 + 9
    ids = sorted(r.event_id for r in norm.movimentacao.collect())
    assert ids == list(range(1, 39))
    diff = R.events_equal_gold(lake.tables, norm, min_support=1).collect()[0]
    assert (diff.only_in_gold, diff.only_in_events) == (0, 0)
    numbers = dict(norm.processo.select("case_id", "case_number").collect())
    assert numbers[100001] == "0100001-25.2026.8.12.0001"


def test_without_the_second_date_parser_the_rules_fail(spark, lake):
    """Negative check: parse ISO only and the day-first dates turn into NULLs, which
    the not-null rule reports, and the two spellings of case 100003 no longer
    collapse, which the unique rule reports."""
    from strata.operators import quality as Q
    from strata.plans import medallion as M

    bronze = lake.bronze["cases"].bronze.drop("_ingerido_em")
    iso_only = M.distinct_typed(M.type_cases(bronze, formats=("iso",))).filter("case_id is not null")
    got = {(r.column_name, r.rule): r.violations for r in Q.run_suite(
        {"stg_cases": iso_only}, [Q.not_null("stg_cases", "opened"),
                                  Q.unique("stg_cases", "case_id")]).collect()}
    assert got[("opened", "not_null")] == 2        # '05/03/2020' and the 'NA' token
    assert got[("case_id", "unique")] == 1         # 100003 twice


def test_sql_views_answer_like_the_dataframe_reports(spark, lake):
    from strata.plans.sql_reports import REPORTS, run_report, serve_views

    t = lake.tables
    serve_views(t, prefix="fx_")
    from strata.plans.sql_reports import run_event_model_report, serve_normalised_views
    b = {k: v.bronze.drop("_ingerido_em") for k, v in lake.bronze.items()}
    norm = normalise(b["cases"], b["districts"], b["classes"])
    serve_normalised_views(norm, prefix="fx_")
    ev = R.duration_from_events(norm, min_support=1)
    assert sorted(map(tuple, run_event_model_report(spark, "fx_", 1).collect())) == \
        sorted(map(tuple, ev.collect()))
    pairs = {"by_district_class_year": R.by_district_class_year(t),
             "by_district_year": R.by_district_year(t),
             "by_court": R.by_court(t, min_support=1),
             "court_key_not_unique": R.court_key_not_unique(t),
             "grain_mean": R.grain(t),
             "fanout_mean": R.fanout(t, t["stg_events"])}
    assert set(pairs) == set(REPORTS)
    for name, df in pairs.items():
        got = run_report(spark, name, prefix="fx_", min_support=1)
        assert got.columns == df.columns, name
        assert list(map(tuple, got.collect())) == list(map(tuple, df.collect())), name  # order too


def test_incremental_lakehouse_equals_batch(spark, lake, tmp_path):
    import shutil

    from strata.plans.lakehouse import build_lakehouse

    landing = {}
    for role, (fmt, name) in {"cases": ("csv", "cases.csv"), "districts": ("csv", "districts.csv"),
                              "classes": ("csv", "classes.csv")}.items():
        d = tmp_path / "landing" / role
        d.mkdir(parents=True)
        shutil.copy(os.path.join(FIXTURES, name), d / name)
        landing[role] = (fmt, str(d))
    d = tmp_path / "landing" / "events"
    d.mkdir(parents=True)
    shutil.copy(os.path.join(FIXTURES, "events.json"), d / "events.json")
    landing["events"] = ("json", str(d))
    inc = build_lakehouse(spark, landing, str(tmp_path / "lake"), incremental=True)
    for name in ("stg_cases", "stg_districts", "stg_classes", "stg_events", "fact_cases",
                 "dim_calendar"):
        assert sorted(map(tuple, inc.tables[name].collect()), key=repr) == \
            sorted(map(tuple, lake.tables[name].collect()), key=repr), name


def test_command_line_build_and_report(spark, tmp_path):
    from strata.__main__ import main

    root = str(tmp_path / "cli")
    assert main(["build", "--root", root, "--cases", f"csv:{FIXTURES}/cases.csv",
                 "--districts", f"csv:{FIXTURES}/districts.csv",
                 "--classes", f"csv:{FIXTURES}/classes.csv",
                 "--events", f"json:{FIXTURES}/events.json"]) == 0
    out = str(tmp_path / "report")
    assert main(["report", "grain_mean", "--root", root, "--out", out]) == 0
    row = spark.read.parquet(out).collect()[0]
    assert row.n_rows == 6



def test_splittable_inputs_give_the_same_bronze(spark, tmp_path):
    """JSON-lines with json_array=False reads the same records as the array file."""
    import json

    from strata.plans.ingest import ingest_file

    lines = tmp_path / "events.jsonl"
    with open(lines, "w", encoding="utf-8") as f:
        for rec in json.load(open(os.path.join(FIXTURES, "events.json"), encoding="utf-8")):
            f.write(json.dumps(rec, ensure_ascii=False) + "\n")
    cols = ["case_id", "event_type", "event_date"]
    a = ingest_file(spark, "json", os.path.join(FIXTURES, "events.json"),
                    str(tmp_path / "b1"), cols).bronze.drop("_ingerido_em")
    b = ingest_file(spark, "json", str(lines), str(tmp_path / "b2"), cols,
                    json_array=False).bronze.drop("_ingerido_em")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert b.count() == 7


def test_quarantine_written_with_reasons(lake):
    q = {r.reject_reason: r.case_id for r in lake.tables["quarantine_cases"].collect()}
    assert q == {"missing_id": None, "unknown_district": "100006"}


def test_quarantine_keeps_every_raw_row(spark):
    from strata.plans.medallion import quarantine_cases, silver_districts

    cols = "case_id string, class_id string, district_id string, court_id string, opened string, closed string, status string"
    rows = [("abc", "1", "1", "1", None, None, "x"), ("xyz", "1", "1", "1", None, None, "x"),
            ("xyz", "1", "1", "1", None, None, "x"), ("7", "1", "9", "1", None, None, "x"), ("8", "1", "1", "1", None, None, "x")]
    d = silver_districts(spark.createDataFrame([("1", "a", "b")], "district_id string, district_name string, uf string"))
    out = quarantine_cases(spark.createDataFrame(rows, cols), d).collect()
    assert sorted((r.case_id, r.reject_reason) for r in out) == [
        ("7", "unknown_district"), ("abc", "missing_id"), ("xyz", "missing_id"), ("xyz", "missing_id")]


def test_profile_summary_finds_each_planted_defect(lake):
    from strata.operators.profile import profile_summary

    b = {k: v.bronze for k, v in lake.bronze.items()}
    got = dict(profile_summary(b["cases"], b["districts"], b["classes"]).collect())
    assert got == {"non_iso_dates": 1, "duplicated_keys": 1, "missing_ids": 1,
                   "orphan_references": 1, "spelling_variants": 1}


def test_command_line_rules_file(spark, tmp_path, capsys):
    from strata.__main__ import main

    spec = tmp_path / "rules.yml"
    spec.write_text("models:\n  - name: stg_cases\n    columns:\n      - name: opened\n"
                    "        tests: [not_null]\n", encoding="utf-8")
    root = str(tmp_path / "cli_rules")
    assert main(["build", "--root", root, "--cases", f"csv:{FIXTURES}/cases.csv",
                 "--districts", f"csv:{FIXTURES}/districts.csv",
                 "--classes", f"csv:{FIXTURES}/classes.csv", "--rules", str(spec)]) == 0
    out = capsys.readouterr().out
    assert "stg_cases" in out and "not_null" in out and "unique" not in out


def test_normaliser_with_custom_column_names(spark, lake):
    from strata.plans.medallion import CaseCols, ClassCols, DistrictCols

    b = {k: v.bronze.drop("_ingerido_em") for k, v in lake.bronze.items()}
    cases = b["cases"].toDF("pid", "cls", "dist", "court", "open_txt", "close_txt", "state")
    districts = b["districts"].toDF("did", "dname", "state_code")
    classes = b["classes"].toDF("cid", "cname")
    norm = normalise(cases, districts, classes,
                     CaseCols("pid", "cls", "dist", "court", "open_txt", "close_txt", "state"),
                     DistrictCols("did", "dname", "state_code"), ClassCols("cid", "cname"))
    ref = normalise(b["cases"], b["districts"], b["classes"])
    for name in ("comarca", "classe", "processo", "movimentacao"):
        assert sorted(map(tuple, getattr(norm, name).collect()), key=repr) == \
            sorted(map(tuple, getattr(ref, name).collect()), key=repr), name


def test_command_line_fanout_report(spark, tmp_path):
    from strata.__main__ import main

    root = str(tmp_path / "cli_fan")
    assert main(["build", "--root", root, "--cases", f"csv:{FIXTURES}/cases.csv",
                 "--districts", f"csv:{FIXTURES}/districts.csv",
                 "--classes", f"csv:{FIXTURES}/classes.csv",
                 "--events", f"json:{FIXTURES}/events.json"]) == 0
    out = str(tmp_path / "fan")
    assert main(["report", "fanout_mean", "--root", root, "--out", out]) == 0
    row = spark.read.parquet(out).collect()[0]
    assert (row.n_rows, row.mean_days) == (5, 253.0)


def test_columns_are_bound_by_header_name(spark, lake, tmp_path):
    import csv

    from strata.plans.lakehouse import DEFAULT_COLUMNS, build_lakehouse

    names = dict(zip(DEFAULT_COLUMNS["cases"], ["id", "klass", "dist", "court", "opened_on", "closed_on", "state"]))
    rows = list(csv.DictReader(open(os.path.join(FIXTURES, "cases.csv"), encoding="utf-8")))
    shuffled = tmp_path / "cases_other_header.csv"
    order = list(reversed(names))
    with open(shuffled, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow([*(names[c] for c in order), "further"])
        w.writerows([*(r[c] for c in order), "x"] for r in rows)
    other = build_lakehouse(spark, {"cases": ("csv", str(shuffled)),
                                    "districts": ("csv", os.path.join(FIXTURES, "districts.csv")),
                                    "classes": ("csv", os.path.join(FIXTURES, "classes.csv"))},
                            str(tmp_path / "lake_named"), columns={"cases": names})
    assert sorted(map(tuple, other.tables["stg_cases"].collect()), key=repr) == \
        sorted(map(tuple, lake.tables["stg_cases"].collect()), key=repr)
    assert other.tables["stg_events"].count() == 0


def test_two_landed_snapshots_give_the_newest_state(spark, tmp_path):
    import time

    from strata.plans.lakehouse import build_lakehouse

    sources = {}
    for role in ("cases", "districts", "classes"):
        (tmp_path / role).mkdir()
        sources[role] = ("csv", str(tmp_path / role))

    def land(day, closed, state, name):
        (tmp_path / "cases" / f"{day}.csv").write_text(
            "case_id,class_id,district_id,court_id,opened,closed,status\n"
            f"1,1,1,1,2020-01-01,{closed},{state}\n2,1,1,1,2020-01-01,2020-02-01,Baixado\n")
        (tmp_path / "districts" / f"{day}.csv").write_text(f"district_id,district_name,uf\n1,{name},ms\n")
        (tmp_path / "classes" / f"{day}.csv").write_text(f"class_id,class_name\n1,{name}\n")

    land("d1", "", "Em andamento", "old")
    build_lakehouse(spark, sources, str(tmp_path / "lake"), incremental=True)
    time.sleep(1.1)
    land("d2", "2020-03-01", "Baixado", "new")
    lake = build_lakehouse(spark, sources, str(tmp_path / "lake"), incremental=True)
    assert sorted((r.case_id, r.status) for r in lake.tables["fact_cases"].collect()) == [(1, "Baixado"), (2, "Baixado")]
    assert [tuple(r) for r in lake.tables["dim_district"].collect()] == [(1, "New", "MS")]
    assert [tuple(r) for r in lake.tables["dim_class"].collect()] == [(1, "new")]
    assert [r.n_closed for r in R.by_court(lake.tables, 1).collect()] == [2]


def test_a_mistyped_year_makes_no_huge_row_and_no_forced_broadcast(spark):
    from strata.operators.calendar import calendar
    from strata.operators.star import role_dim

    cases = spark.sql("select date'2024-12-30' as o, cast('12025-03-11' as date) as c")
    cal = calendar(cases, "o", "c")
    assert cal.count() == spark.sql("select datediff(cast('12025-03-11' as date), date'2024-12-30') + 1 as n").first().n
    assert cal.select(F.spark_partition_id()).distinct().count() > 1
    assert not role_dim(cal, "o").bounded
