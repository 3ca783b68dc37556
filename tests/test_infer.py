"""Types inferred from all rows, against DuckDB's sniffer reading every row."""

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.plans.bound_increments import _customer_folder, _orders_folder
from strata.sources.infer import infer_types, merged, read_csv_inferred, state, typed, types_of
from tests.conftest import SF_SMALL

NAMES = {"BOOLEAN": "boolean", "BIGINT": "bigint", "HUGEINT": "decimal(38,0)", "DOUBLE": "double", "DATE": "date",
         "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string"}
CASES = [
    ["true", "false"], ["True", "FALSE"], ["t", "f"], ["0", "1"], ["yes", "no"], ["true", "1"], ["1", "2", ""], ["+1", "2"], ["007", "8"],
    ["1.5", "2"], ["1e3", "2"], ["1_000", "2"], [".5", "1."], ["inf", "1"], ["nan", "1"], ["9223372036854775808", "1"],
    ["2024-01-05", "2024-02-06"], ["2024/01/05", "2024/02/06"], ["05/01/2024", "28/02/2024"], ["01/05/2024", "02/28/2024"],
    ["05-01-2024", "28-02-2024"], ["2024-01-05 10:11:12", "2024-01-06"], ["2024-01-05T10:11:12", "2024-01-06T00:00:00"], ["", ""],
    ["a", "1"], ["1", "a"], [" 1", "2"], ["2024-1-5", "2024-02-06"], ["20240105", "20240106"], ["true", ""], ["1", "true"], ["1.0", "2.0"],
    ["-0", "5"], ["2024-01-05 10:11:12.5", "2024-01-05"], ["01/02/2024", "03/04/2024"], ["12345678901234567890.5", "1"],
    ["2024-02-30", "2024-01-01"]]


def sniffed(path):
    src = f"read_csv('{path}', sample_size=-1, header=true)"
    con = duckdb.connect()
    return {r[0]: r[1] for r in con.sql(f"describe select * from {src}").fetchall()}, con.sql(f"select * from {src}")


def test_every_kind_of_column_equals_the_sniffer(spark, tmp_dir):
    n = max(map(len, CASES))
    rows = [tuple(c[i] if i < len(c) else "" for c in CASES) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(CASES))))
    kinds = {r.column_name: r.type for r in types_of(state(df)).collect()}
    out = infer_types(df).collect()
    for i, values in enumerate(CASES):
        path = f"{tmp_dir}/{i}.csv"
        with open(path, "w") as f:
            f.write("k,v\n" + "".join(f"x{j},{v}\n" for j, v in enumerate(values)))
        types, rel = sniffed(path)
        assert kinds[f"c{i}"] == NAMES[types["v"]], values
        got, want = [r[i] for r in out][:len(values)], [r[1] for r in rel.fetchall()]
        assert [str(float(x)) if isinstance(x, float) else str(x) for x in got] == [str(x) for x in want], values


@pytest.mark.parametrize("folder", [_customer_folder, _orders_folder])
def test_tables_equal_the_sniffed_read(spark, tmp_dir, folder):
    """Column by column: the sniffer settles on one date order a file, we on one a column."""
    path = folder(spark, SF_SMALL)
    got = read_csv_inferred(spark, path)
    key, con = got.columns[0], duckdb.connect()
    con.execute(f"create table t as select * from read_csv('{path.removeprefix('file:')}/*.csv', all_varchar=true, header=true)")
    rows = {str(r[key]): r for r in got.collect()}
    for c, kind in got.dtypes:
        con.execute(f"copy (select {key} as k, {c} as v from t) to '{tmp_dir}/{c}.csv' (header)")
        types, rel = sniffed(f"{tmp_dir}/{c}.csv")
        if c == "stamp":  # the sniffer takes bare dates among stamps only if a stamp comes first
            assert kind == "timestamp_ntz"
            continue
        assert kind == NAMES[types["v"]], c
        assert {str(k): str(v) for k, v in rel.fetchall()} == {k: str(r[c]) for k, r in rows.items()}, c


def test_a_single_late_row_decides(spark):
    df = spark.range(50_000).select(F.when(F.col("id") == 49_999, F.lit("x")).otherwise(F.col("id").cast("string")).alias("v"))
    assert types_of(state(df)).first()["type"] == "string"


def test_states_of_batches_merge(spark):
    a = spark.createDataFrame([("1", "2024-01-01"), ("2", None)], "n string, d string")
    b = spark.createDataFrame([("2.5", "2024-01-02 10:00:00", "new")], "n string, d string, more string")
    got = {r.column_name: (r.type, r.n_rows, r.n_null, r.max_chars) for r in types_of(merged([state(a), state(b)])).collect()}
    assert got == {"n": ("double", 3, 0, 3), "d": ("timestamp_ntz", 3, 1, 19), "more": ("string", 1, 0, 3)}


def test_a_value_outside_its_kind_is_an_error(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    with pytest.raises(Exception, match="no bigint: x"):
        typed(df, {"n": "bigint"}).collect()


def test_empty_table_is_text(spark):
    df = spark.createDataFrame([], "a string, `b c` string")
    assert {r.column_name: (r.type, r.n_rows) for r in types_of(state(df)).collect()} == {"a": ("string", 0), "b c": ("string", 0)}
    assert infer_types(df).collect() == []
