import datetime as dt

from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators import profile as P


def results(df):
    return {(r.table_name, r.column_name, r.rule): (r.violations, r.passed) for r in df.collect()}


def test_rules_pass_and_fail(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (2, None, "z"), (None, "a", "x")],
                              "id int, status string, fk string")
    p = spark.createDataFrame([("x",), ("y",)], "k string")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id int, status string")
    rules = [Q.not_null("t", "id"), Q.unique("t", "id"), Q.accepted_values("t", "status", ["a", "b"]),
             Q.relationships("t", "fk", "p", "k"),
             Q.not_null("g", "id"), Q.unique("g", "id"), Q.accepted_values("g", "status", ["a", "b"])]
    got = results(Q.run_suite({"t": t, "p": p, "g": good}, rules))
    assert got[("t", "id", "not_null")] == (1, False)
    assert got[("t", "id", "unique")] == (1, False)          # value 2 repeated; NULL ignored
    assert got[("t", "status", "accepted_values")] == (0, True)  # NULL passes
    assert got[("t", "fk", "relationships")] == (1, False)   # 'z' has no parent
    assert got[("g", "id", "not_null")] == (0, True)
    assert got[("g", "id", "unique")] == (0, True)
    bad = spark.createDataFrame([("c",), ("c",), ("d",)], "status string")
    got = results(Q.run_suite({"b": bad}, [Q.accepted_values("b", "status", ["a"])]))
    assert got[("b", "status", "accepted_values")] == (2, False)   # distinct bad values


def test_relationships_counts_orphan_rows(spark):
    child = spark.createDataFrame([(9,), (9,), (1,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    got = results(Q.run_suite({"c": child, "p": parent}, [Q.relationships("c", "k", "p", "k")]))
    assert got[("c", "k", "relationships")] == (2, False)


def test_ingestion_checks(spark):
    src = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    bronze = src.withColumn("_ingerido_em", F.lit("2024-01-01T00:00:00+00:00"))
    got = {r.check_name: r.passed for r in Q.ingestion_checks(src, bronze, ["id", "v"]).collect()}
    assert got == {"row_count": True, "stamp_column": True, "required_columns": True}
    got = {r.check_name: r.passed
           for r in Q.ingestion_checks(src, src.limit(1), ["id", "w"]).collect()}
    assert got == {"row_count": False, "stamp_column": False, "required_columns": False}


def test_profiles(spark):
    raw = spark.createDataFrame(
        [("1", "2025-03-11", "10"), ("1", "11/03/2025", "10"), (None, "2025/03/11", "99"),
         ("", "2025", "20"), ("5", "2025-03-11 08:00", "20"), ("6", None, "10")],
        "id string, d string, district string")
    fmts = dict(P.mixed_formats(raw, "d").collect())
    assert fmts == {"iso": 1, "day_first_slash": 1, "year_first_slash": 1, "other": 1,
                    "iso_with_time": 1, "null": 1}
    assert dict(P.duplicate_keys(raw, "id").collect()) == {"1": 2}
    assert P.missing_ids(raw, "id").count() == 2
    dist = spark.createDataFrame([("10",), ("20",)], "district string")
    assert [r.district for r in P.orphans(raw, dist, "district").collect()] == ["99"]
    assert dict(P.values_with(raw, "d", "/").collect()) == {"11/03/2025": 1, "2025/03/11": 1}


def test_spelling_variants(spark):
    df = spark.createDataFrame([(2, "Cobrança Estadual"), (2, "COBRANCA ESTADUAL"), (2, "COBRANCA ESTADUAL"),
                                (1, "Ação")], "k int, name string")
    got = sorted(tuple(r) for r in P.spelling_variants(df, "k", "name").collect())
    assert got == [(2, "COBRANCA ESTADUAL", 2, 2), (2, "Cobrança Estadual", 1, 2)]


def test_schema_drift(spark):
    before = spark.createDataFrame([("1", "x"), ("b", None)], "id string, name string")
    after = before.select(F.col("id").try_cast("int").alias("id"), F.lit(1).alias("extra"))
    got = {r.column_name: tuple(r)[1:] for r in P.schema_drift(before, after).collect()}
    assert got["id"] == ("string", 2, "int", 1)
    assert got["name"] == ("string", 1, None, None)
    assert got["extra"] == (None, None, "int", 2)


SPEC = """
version: 2
models:
  - name: child
    columns:
      - name: id
        tests:
          - not_null
          - unique
      - name: status
        tests:
          - accepted_values:
              arguments:
                values: ['a', 'b']
      - name: fk
        tests:
          - relationships:
              arguments:
                to: ref('parent')
                field: k
  - name: parent
    columns:
      - name: k
        tests: [not_null, unique]
"""


def test_rules_from_declarative_spec(spark):
    rules = Q.rules_from_spec(SPEC)
    assert [(r.table, r.column, r.kind) for r in rules] == [
        ("child", "id", "not_null"), ("child", "id", "unique"),
        ("child", "status", "accepted_values"), ("child", "fk", "relationships"),
        ("parent", "k", "not_null"), ("parent", "k", "unique")]
    assert rules[2].values == ("a", "b") and rules[3].to_table == "parent"
    child = spark.createDataFrame([(1, "a", "x"), (1, "c", "y")], "id int, status string, fk string")
    parent = spark.createDataFrame([("x",)], "k string")
    got = {(r.column_name, r.rule): r.violations
           for r in Q.run_suite({"child": child, "parent": parent}, rules).collect()}
    assert got[("id", "unique")] == 1 and got[("status", "accepted_values")] == 1
    assert got[("fk", "relationships")] == 1 and got[("k", "unique")] == 0
