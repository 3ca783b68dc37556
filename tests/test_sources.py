import json
import os

from strata.plans.ingest import ingest_file
from strata.sources import file_sizes, read_csv_text, read_json_text
from tests.conftest import FIXTURES, SF_SMALL


def test_csv_text_quotes_newlines_and_na_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('id,name,note\n1,"Vale ""Alto""","line one\nline two"\n2,NA,null\n3,,  keep  \n'
                '8000001.0,N/A,None\n')
    rows = read_csv_text(spark, path).collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'Vale "Alto"', "line one\nline two"), ("2", None, None), ("3", None, "  keep  "),
        ("8000001.0", None, None)]
    assert all(t == "string" for _, t in read_csv_text(spark, path).dtypes)


def test_json_array_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "e.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump([{"id": 8000001, "t": "Baixa", "d": "2020-01-01"},
                   {"id": None, "t": None, "d": "01/02/2020"}, {"id": 12, "t": "x", "d": None}], f)
    df = read_json_text(spark, path, ["id", "t", "d"])
    assert [tuple(r) for r in df.collect()] == [("8000001", "Baixa", "2020-01-01"),
                                                (None, None, "01/02/2020"), ("12", "x", None)]
    inferred = read_json_text(spark, path)
    assert all(t == "string" for _, t in inferred.dtypes)


def test_ingest_preserves_rows_and_stamps(spark, tmp_dir):
    out = ingest_file(spark, "csv", os.path.join(FIXTURES, "cases.csv"),
                      os.path.join(tmp_dir, "bronze", "cases"), batch_ts="2024-01-01T00:00:00+00:00")
    assert out.rows == 12 == out.bronze.count()
    assert "_ingerido_em" in out.bronze.columns
    assert {r[0] for r in out.bronze.select("_ingerido_em").distinct().collect()} == \
        {"2024-01-01T00:00:00+00:00"}
    assert set(out.bronze.columns) >= {"case_id", "opened", "closed"}


def test_catalog_path_sql_and_views(spark, tmp_dir):
    from strata.sinks import register_view, write_table
    from strata.sources import SourceCatalog, parquet_path_sql

    cat = SourceCatalog(SF_SMALL + "/{name}.parquet")
    views = cat.register(spark, ["nation", "region"])
    assert spark.sql("select count(*) from nation").collect()[0][0] == views["nation"].count() == 25
    got = parquet_path_sql(spark, cat.path("region"),
                           "select count(*) as n from {src} where r_regionkey >= 0").collect()[0].n
    assert got == 5
    out = os.path.join(tmp_dir, "nation_by_region")
    write_table(views["nation"], out, partition_by=["n_regionkey"])
    assert sorted(d for d in os.listdir(out) if d.startswith("n_regionkey="))[0] == "n_regionkey=0"
    served = register_view(spark, "served_nation", out)
    assert spark.sql("select count(*) from served_nation where n_regionkey = 1").collect()[0][0] == 5
    assert served.filter("n_regionkey = 1").count() == 5


def test_preview(spark):
    from pyspark.sql import functions as F

    from strata.sources import preview

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert preview(df).count() == 10
    top = preview(df, 3, [F.col("o_orderkey").desc()]).collect()
    assert [r.o_orderkey for r in top] == sorted((r.o_orderkey for r in df.collect()), reverse=True)[:3]
    plan = preview(df, 3, [F.col("o_orderkey").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_csv_is_bound_by_name_and_malformed_records_do_not_vanish(spark, tmp_dir):
    import pytest

    from strata.sources import count_records
    from strata.sources.text_files import CORRUPT

    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('b,a,extra\n1,2,3\n4,5,6,7\n8\n"x, ""y""",9,\n')
    with pytest.raises(Exception, match="4,5,6,7"):
        read_csv_text(spark, path, ["a", "b"]).collect()
    got = read_csv_text(spark, path, {"A": "a", "B": "b"}, on_malformed="quarantine")
    assert got.columns[:2] == ["A", "B"] and "extra" in got.columns
    rows = {(r.A, r.B, r[CORRUPT]) for r in got.collect()}
    assert rows == {("2", "1", None), ("5", "4", "4,5,6,7"), (None, "8", None), ("9", 'x, "y"', None)}
    with pytest.raises(ValueError, match="not in the header"):
        read_csv_text(spark, path, ["a", "zzz"])
    assert count_records(spark, "csv", path).first().n == count_records(spark, "csv", path, multiline=False).first().n == 4


def test_json_is_bound_by_key_and_broken_records_fail(spark, tmp_dir):
    import pytest

    from strata.sources import count_records

    path = os.path.join(tmp_dir, "m.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"k": 1, "v": "a"}\n{"v": "b", "k": 2}\n')
    assert sorted(map(tuple, read_json_text(spark, path, {"id": "k"}, array=False).collect())) == [("1",), ("2",)]
    with pytest.raises(Exception, match="malformed JSON"):
        read_json_text(spark, path, ["other"], array=False).collect()
    with open(path, "a", encoding="utf-8") as f:
        f.write("{broken\n")
    with pytest.raises(Exception, match="broken"):
        read_json_text(spark, path, ["k", "v"], array=False).collect()
    assert count_records(spark, "json", path, array=False).first().n == 3
