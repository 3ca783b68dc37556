import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (case_number, duration_days, is_shouting, is_weekend, month_name,
                              parse_mixed_date, safe_int, strict_int, title_case)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_safe_int_accepts_decimal_and_exponent_text(spark):
    vals = ["8000001", "8000001.0", "1e3", " 12", "abc", "", None, "2.5", "-2.5",
            "99999999999999999999"]
    got = one_col(spark, vals, lambda c: safe_int(c, "bigint"))
    assert got[:3] == [8000001, 8000001, 1000]
    assert got[4:7] == [None, None, None]
    assert got[7:9] == [3, -3]          # half away from zero
    assert got[9] is None               # out of bigint range


def test_safe_int_int_overflow_is_null(spark):
    got = one_col(spark, ["2147483647", "3000000000"], lambda c: safe_int(c, "int"))
    assert got == [2147483647, None]


def test_strict_int_raises(spark):
    import pytest
    df = spark.createDataFrame([("x1",)], "x string")
    with pytest.raises(Exception):
        df.select(strict_int("x")).collect()


def test_parse_mixed_date_formats(spark):
    vals = ["2025-03-11", "2025/03/11", "11/03/2025", "1/3/2025", "2025-03-11 10:00:00",
            "2025", "31/02/2025", "11/03/2025 trailing", "garbage", None, "  2025-3-1"]
    got = one_col(spark, vals, lambda c: parse_mixed_date(c))
    d = dt.date
    assert got[0] == d(2025, 3, 11)
    assert got[1] == d(2025, 3, 11)        # slash ISO accepted
    assert got[2] == d(2025, 3, 11)        # day-first fallback
    assert got[3] == d(2025, 3, 1)         # one-digit day and month
    assert got[4] == d(2025, 3, 11)        # clock suffix accepted
    assert got[5] is None                  # a bare year is not a date
    assert got[6] is None                  # impossible day
    assert got[7] is None                  # trailing text after day-first date
    assert got[8] is None and got[9] is None
    assert got[10] == d(2025, 3, 1)


def test_title_case(spark):
    vals = ["  TRÊS LAGOAS", "dourados", "naviraí ", "são  joão", "anti-horário d'oeste", None]
    got = one_col(spark, vals, title_case)
    assert got == ["Três Lagoas", "Dourados", "Naviraí", "São  João", "Anti-horário D'oeste",
                   None]


def test_is_shouting(spark):
    got = one_col(spark, ["COBRANCA ESTADUAL", "Cobrança Estadual", None], is_shouting)
    assert got == [True, False, None]


def test_duration_days(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 10), dt.date(2021, 1, 9)), (dt.date(2021, 1, 31), dt.date(2021, 1, 16)),
         (dt.date(2020, 1, 1), None), (None, dt.date(2020, 1, 1)),
         (dt.date(2020, 1, 1), dt.date(2020, 1, 1))], "o date, c date")
    got = [r[0] for r in df.select(duration_days("o", "c")).collect()]
    assert got == [365, None, None, None, 0]
    assert dict(df.select(duration_days("o", "c").alias("d")).dtypes)["d"] == "bigint"


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),),
                                (dt.date(2024, 3, 10),)], "d date")
    got = df.select(month_name("d"), is_weekend("d")).collect()
    assert [tuple(r) for r in got] == [("Janeiro", True), ("Janeiro", False), ("Março", True)]


def test_case_number(spark):
    df = spark.createDataFrame([(8000001, 1), (123456789012, 42)], "id long, d int")
    got = [r[0] for r in df.select(case_number("id", "d")).collect()]
    assert got == ["8000001-25.2026.8.12.0001", "6789012-25.2026.8.12.0042"]


def test_sized_conf_scales_from_tiny_to_huge():
    from strata.session import MIB, sized_conf

    tiny = sized_conf(14 * MIB, 8)
    assert tiny["spark.sql.files.maxPartitionBytes"] == str(MIB)
    assert tiny["spark.sql.shuffle.partitions"] == "8"
    huge = sized_conf(100 * 1024 ** 4, 8000)
    assert huge["spark.sql.files.maxPartitionBytes"] == str(128 * MIB)
    assert huge["spark.hadoop.parquet.block.size"] == str(128 * MIB)
    assert huge["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 * MIB))
    assert huge["spark.sql.files.openCostInBytes"] == str(4 * MIB)


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from strata.session import ensure_checkpoint_dir, is_local

    class Session:
        def __init__(self, master):
            self.sparkContext = self
            self.master, self.conf = master, {}

        def getCheckpointDir(self):
            return None

    assert all(is_local(Session(m)) for m in ("local", "local[4]", "local[*]"))
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(Session(master))
