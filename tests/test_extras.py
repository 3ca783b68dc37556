import datetime as dt

from pyspark.sql import functions as F

from strata.operators import extras as X

D = dt.date


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 10), (None, 10), (3, None)], "id long, d int")
    tagged = X.tag_rejects(df, [("missing_id", F.col("id").isNull()),
                                ("missing_district", F.col("d").isNull())])
    clean, rejected = X.split_rejects(tagged)
    assert [tuple(r) for r in clean.collect()] == [(1, 10)]
    assert {r.reject_reason: r.id for r in rejected.collect()} == \
        {"missing_id": None, "missing_district": 3}


def test_unknown_member(spark):
    dim = spark.createDataFrame([(1, "A", "MS")], "k int, name string, uf string")
    fact = spark.createDataFrame([(1,), (99,), (None,)], "k int")
    dim2 = X.with_unknown_member(dim, "k", "name")
    assert sorted(tuple(r) for r in dim2.collect()) == [(0, "Não informado", None), (1, "A", "MS")]
    assert sorted(r.k for r in X.remap_orphans(fact, dim, "k").collect()) == [0, 0, 1]


def test_aged_and_keep_latest(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), None), (D(2020, 1, 1), D(2020, 1, 5)),
                                (D(2021, 1, 1), None)], "o date, c date")
    got = [r[0] for r in df.select(X.aged_duration_days("o", "c", "2020-01-11")).collect()]
    assert got == [10, 4, None]
    snaps = spark.createDataFrame([(1, None, "open"), (1, D(2020, 2, 1), "closed"), (2, None, "open")],
                                  "k int, v date, s string")
    assert sorted(tuple(r) for r in X.keep_latest(snaps, "k", "v").collect()) == \
        [(1, D(2020, 2, 1), "closed"), (2, None, "open")]


def test_scd2_history(spark):
    snaps = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (1, "a", D(2024, 2, 1)),
                                   (1, "b", D(2024, 3, 1)), (2, "x", D(2024, 1, 1))],
                                  "k int, name string, as_of date")
    got = sorted(tuple(r) for r in X.scd2_history(snaps, "k", ["name"], "as_of").collect())
    assert got == [(1, "a", D(2024, 1, 1), D(2024, 3, 1), False),
                   (1, "b", D(2024, 3, 1), None, True), (2, "x", D(2024, 1, 1), None, True)]


def test_drill_across_and_row_hash(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, x int")
    b = spark.createDataFrame([(2, 7), (3, 8)], "k int, y int")
    got = sorted(tuple(r) for r in X.drill_across(a, b, ["k"]).collect())
    assert got == [(1, 5, None), (2, 6, 7), (3, None, 8)]
    h = spark.createDataFrame([("a", None), ("a", "")], "p string, q string").select(
        X.row_hash(["p", "q"]).alias("h")).collect()
    assert h[0].h != h[1].h                          # NULL and empty differ


def test_scd2_merge_step_by_step_equals_history(spark):
    snaps = [
        (D(2024, 1, 1), [(1, "a"), (2, "x")]),
        (D(2024, 2, 1), [(1, "a"), (2, "y"), (3, "n")]),
        (D(2024, 3, 1), [(1, "b"), (2, "y"), (3, "n")]),
    ]
    hist = None
    for as_of, rows in snaps:
        snap = spark.createDataFrame(rows, "k int, name string")
        hist = X.scd2_merge(hist, snap, "k", ["name"], as_of)
        hist = spark.createDataFrame(hist.collect(), hist.schema)   # materialise the step
    allsnaps = spark.createDataFrame([(k, n, d) for d, rows in snaps for k, n in rows],
                                     "k int, name string, as_of date")
    expected = X.scd2_history(allsnaps, "k", ["name"], "as_of")
    key = lambda r: (r.k, r.valid_from)
    assert sorted(map(tuple, hist.collect()), key=lambda t: (t[0], t[2])) == \
        sorted(map(tuple, expected.select(hist.columns).collect()), key=lambda t: (t[0], t[2]))
