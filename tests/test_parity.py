"""Lenient casts agree with DuckDB's; mixed dates and title case give the expected values on
tricky text."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.functions import parse_mixed_date, safe_int, title_case

INTS = ["8000001", "8000001.0", "1e3", " 12", "12 ", "+5", "-0", ".5", "-2.5", "2.5", "1,000",
        "0x10", "-0x10", "0X1F", "0b101", " 0x10 ", "1_000", "12abc", "", "NaN", "inf",
        "9223372036854775807", "9223372036854775808", "0x7FFFFFFFFFFFFFFF", "0x8000000000000000",
        "1.5e2", "  7  ", "007", "-12.4999", "1__000", "_1", "1_", "-1_000", "+1_000",
        "1_000.5", "1e_3", "0x1_0", "0b1_0", "1_000e2", " 1_000 ", "0X", "0x-1", "00x10", "1.",
        "-.5", "+.5", "1e-1", "5e-1", "1.5e0", "2.49999999999",
        "2.50000000000000000001", "0x" + "0" * 64 + "1F", "0b" + "0" * 256 + "101",
        "0x11111111111111111", "0x" + "0" * 20 + "FFFFFFFFFFFFFFFF", "0x0000", "0b0", "0b" + "1" * 65, None]
DATES = ["2025-03-11", "2025-3-1", " 2025-03-11", "2025-03-11 ", "\t2025-03-11", "2025-03-11T10:00",
         "2025-03-11 10:00:00", "2025-03-11 10:00", "2025-03-11 10", "2025-03-11T", "2025-03-11 x",
         "2025-03-11 25:00:00", "2025-03-11 10:00:00 x", "2025-03-11T10:00:00Z", "+2025-03-11",
         "02025-03-11", "2025/3/1", "2025/03/11 x", "2025-03/11", "11/3/2025", "11/03/2025",
         "1/3/2025", "31/02/2025", "2025-02-30", "2025-13-01", "11/03/25", "1/3/5", "5-3-1", "2025",
         "11-03-2025", "2025.03.11", "20250311", "11/03/2025 ", " 11/03/2025", "\t11/03/2025",
         "11/3/25", "11/03/0025", "25/12/99", "13/13/25", "011/03/2025", "11/03/2025 x",
         "0001-01-01", "9999-12-31", "2024-02-29", "2023-02-29", "29/02/2024", "1/01/00",
         "0000-01-01", None]
# Expected days; texts that are not named here are no dates.
DAYS = {
    "2025-03-11": "2025-03-11", "2025-3-1": "2025-03-01", " 2025-03-11": "2025-03-11",
    "2025-03-11 ": "2025-03-11", "\t2025-03-11": "2025-03-11", "2025-03-11T10:00": "2025-03-11",
    "2025-03-11 10:00:00": "2025-03-11", "2025-03-11 10:00": "2025-03-11", "2025-03-11 10:00:00 x": "2025-03-11",
    "2025-03-11T10:00:00Z": "2025-03-11", "02025-03-11": "2025-03-11", "2025/3/1": "2025-03-01",
    "11/3/2025": "2025-03-11", "11/03/2025": "2025-03-11", "1/3/2025": "2025-03-01",
    "11/03/25": "0011-03-25", "1/3/5": "0001-03-05", "5-3-1": "0005-03-01",
    "11/03/2025 ": "2025-03-11", " 11/03/2025": "2025-03-11", "\t11/03/2025": "2025-03-11",
    "11/3/25": "0011-03-25", "11/03/0025": "0025-03-11", "25/12/99": "0099-12-25",
    "0001-01-01": "0001-01-01", "9999-12-31": "9999-12-31", "2024-02-29": "2024-02-29",
    "29/02/2024": "2024-02-29"}
# Expected spellings.
TITLES = {
    "  TRÊS LAGOAS": "Três Lagoas", "são  joão": "São  João", "anti-horário d'oeste": "Anti-horário D'oeste",
    "ÉVORA": "Évora", "mcDONALD": "Mcdonald", "a\tb": "A\tb",
    " x ": "X", "": "", None: None}
CASTS = {"int": "bigint", "int32": "integer"}


@pytest.mark.parametrize("kind,values,fn", [("int", INTS, lambda c: safe_int(c, "bigint")),
                                            ("int32", INTS + ["2147483647", "2147483648",
                                                              "-2147483648", "0x7FFFFFFF",
                                                              "0x80000000"],
                                             lambda c: safe_int(c, "int"))])
def test_casts_match_duckdb(spark, kind, values, fn):
    con = duckdb.connect()
    expected = [con.execute(f"select try_cast(?::varchar as {CASTS[kind]})", [v]).fetchone()[0] for v in values]
    assert list(zip(values, of(spark, values, fn))) == list(zip(values, expected))


def of(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_mixed_dates(spark):
    expected = [dt.date.fromisoformat(DAYS[v]) if v in DAYS else None for v in DATES]
    assert list(zip(DATES, of(spark, DATES, parse_mixed_date))) == list(zip(DATES, expected))


def test_title_case(spark):
    assert dict(zip(TITLES, of(spark, list(TITLES), title_case))) == TITLES
