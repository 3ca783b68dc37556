"""Property-based checks against brute force (small random inputs)."""

import calendar
import datetime as dt
import re

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import parse_mixed_date
from strata.operators import dense_ids, keep_preferred, prefer_not_shouting

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

labels = st.one_of(st.none(), st.sampled_from(["Alpha", "ALPHA", "alpha", "Beta", "BETA", "b", "B", ""]))
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), labels), min_size=0, max_size=40)


def _pref_key(label):
    # (not-all-caps first, NULL last), then the label (NULL last)
    shout = None if label is None else label == label.upper()
    return (shout is None, shout if shout is not None else False, label is None, label or "")


@SETTINGS
@given(rows)
def test_keep_preferred_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, name string")
    got = sorted(((r.k, r.name) for r in keep_preferred(df, "k", prefer_not_shouting("name")).collect()),
                 key=repr)
    best = {}
    for k, name in data:
        if k not in best or _pref_key(name) < _pref_key(best[k]):
            best[k] = name
    assert got == sorted(best.items(), key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 2)), max_size=60),
       st.integers(1, 5))
def test_dense_ids_are_a_sorted_permutation(spark, data, parts):
    df = spark.createDataFrame(data, "a int, b int")
    out = dense_ids(df, ["a"], "id", num_partitions=parts).collect()
    assert sorted(r.id for r in out) == list(range(1, len(data) + 1))
    ordered = [(r.a, r.b) for r in sorted(out, key=lambda r: r.id)]
    assert ordered == sorted(data, key=lambda t: (t[0] is None, t[0] or 0, t[1]))


years = st.integers(1, 9999)
months = st.integers(0, 13)
days = st.integers(0, 32)


@st.composite
def date_text(draw):
    y, m, d = draw(years), draw(months), draw(days)
    style = draw(st.sampled_from(["iso", "iso_slash", "dmy", "dmy_pad", "iso_time", "junk"]))
    ys = str(y) if draw(st.booleans()) else f"{y:04d}"
    if style == "iso":
        return f"{ys}-{m}-{d}"
    if style == "iso_slash":
        return f"{ys}/{m:02d}/{d:02d}"
    if style == "dmy":
        return f"{d}/{m}/{ys}"
    if style == "dmy_pad":
        return f" {d:02d}/{m:02d}/{ys} "
    if style == "iso_time":
        return f"{ys}-{m:02d}-{d:02d} {draw(st.integers(0, 25))}:{draw(st.integers(0, 61)):02d}"
    return f"{d}.{m}.{ys}"


def day_of(text, con):
    """DuckDB's cast for year-first text; day-first text read here."""
    year_first = con.execute("select try_cast(?::varchar as date)::varchar", [text]).fetchone()[0]
    if year_first is not None:
        return None if "(BC)" in year_first else dt.date.fromisoformat(year_first)
    parts = re.fullmatch(r"\s*([0-9]{1,2})/([0-9]{1,2})/([0-9]{1,4})\s*", text)
    if parts:
        d, m, y = map(int, parts.groups())
        if 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]:
            return dt.date(y, m, d)
    return None


@SETTINGS
@given(st.lists(date_text(), min_size=1, max_size=30))
def test_mixed_dates_match_their_days(spark, texts):
    con = duckdb.connect()
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(parse_mixed_date(F.col("x"))).collect()]
    assert list(zip(texts, got)) == [(t, day_of(t, con)) for t in texts]
