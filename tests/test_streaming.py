import os
import re
import shutil

from strata.streaming import ingest_available, start_bronze_stream
from strata.streaming.bronze_stream import EXTRACT, read_landing
from tests.conftest import FIXTURES

COLS = ["case_id", "class_id", "district_id", "court_id", "opened", "closed", "status"]


def test_incremental_ingest_is_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    shutil.copy(os.path.join(FIXTURES, "cases.csv"), os.path.join(landing, "a.csv"))
    bronze, ckpt = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt")
    first = ingest_available(spark, "csv", landing, COLS, bronze, ckpt)
    assert first.count() == 12
    assert first.select("_ingerido_em").distinct().count() == 1
    # a re-run with nothing new adds nothing
    assert ingest_available(spark, "csv", landing, COLS, bronze, ckpt).count() == 12
    # a new extract is picked up alone
    shutil.copy(os.path.join(FIXTURES, "cases.csv"), os.path.join(landing, "b.csv"))
    again = ingest_available(spark, "csv", landing, COLS, bronze, ckpt)
    assert again.count() == 24
    assert again.filter("opened is null").count() == 2      # 'NA' token, once per file


def test_json_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    shutil.copy(os.path.join(FIXTURES, "events.json"), os.path.join(landing, "e.json"))
    q = start_bronze_stream(spark, "json", landing, ["case_id", "event_type", "event_date"],
                            os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "c"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp_dir, "b")).count() == 7


def test_stream_stamp_has_the_batch_stamp_shape(spark, tmp_dir):
    import re

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    shutil.copy(os.path.join(FIXTURES, "cases.csv"), os.path.join(landing, "a.csv"))
    out = ingest_available(spark, "csv", landing, COLS, os.path.join(tmp_dir, "b"),
                           os.path.join(tmp_dir, "c"))
    stamp = out.select("_ingerido_em").first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", stamp), stamp


def test_folder_names_of_extracts_are_cut_without_a_pattern_per_record(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "a b", "landing")
    for name in ("extract-2", "extract 10", "é"):
        os.makedirs(os.path.join(landing, name))
        with open(os.path.join(landing, name, "part.json"), "w") as f:
            f.write('{"case_id": "%s"}\n' % name)
    read = read_landing(spark, "json", landing, ["case_id"], json_array=False, extract_folders=True)
    assert "regexp_extract" not in read._jdf.queryExecution().analyzed().toString()
    got = ingest_available(spark, "json", landing, ["case_id"], os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "c"),
                           json_array=False, extract_folders=True).collect()
    old = r"([^/]+)/[^/]+$"
    paths = [r.p for r in spark.read.option("recursiveFileLookup", True).json(landing).selectExpr("_metadata.file_path as p").collect()]
    assert len(got) == 3 and {r[EXTRACT] for r in got} == {re.search(old, p).group(1) for p in paths}
