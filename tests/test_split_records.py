"""Files read in splits give what the whole-file readers give."""

import json
import os
import random

import pytest

from strata.operators.quality import ingestion_checks
from strata.plans.ingest import ingest_file
from strata.sources.split_records import CSV, JSON_ARRAY, read_csv_records, read_json_array_records, split_records, split_states
from strata.sources.text_files import CORRUPT, read_csv_text, read_json_text

BITS = ["a", "é", "\n", '"', ",", " ", "xyz", "\r\n", "}", "{", "[", "]", "\\", "😀"]


def field(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 30)))


def quoted(s, rng):
    return '"' + s.replace('"', '""') + '"' if any(c in s for c in '\n",\r') or rng.random() < 0.2 else s


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(str([r[c] for c in sorted(df.columns)]) for r in df.collect())


def csv_file(path, values, rng, end="\n"):
    write(path, "id,a,b" + end + "".join(",".join(quoted(v, rng) for v in r) + end for r in values))


def test_csv_equals_the_whole_file_reader(small_splits, tmp_dir):
    rng = random.Random(4)
    for k in range(2):
        csv_file(f"{tmp_dir}/in/f{k}.csv", [(str(i), field(rng), field(rng)) for i in range(400)], rng)
    path = f"{tmp_dir}/in"
    assert split_states(small_splits, path, CSV).groupBy("file").count().agg({"count": "min"}).first()[0] > 5
    got = read_csv_records(small_splits, path, ["id", "a", "b"], null_tokens=None)
    assert rows(got) == rows(read_csv_text(small_splits, path, ["id", "a", "b"], null_tokens=None))


def test_csv_values_are_those_written_whatever_the_line_ends(small_splits, tmp_dir):
    rng = random.Random(5)
    values = [(str(i), field(rng), field(rng)) for i in range(300)]
    csv_file(f"{tmp_dir}/in/f.csv", values, rng, end="\r\n")
    got = read_csv_records(small_splits, f"{tmp_dir}/in", null_tokens=None).collect()
    assert sorted((r.id, r.a or "", r.b or "") for r in got) == sorted(values)


def test_a_record_over_many_splits_and_a_long_header(small_splits, tmp_dir):
    long = "\n".join(f'line {i} "x", y' for i in range(400))
    write(f"{tmp_dir}/in/f.csv", '"id\n' + "h" * 3000 + '",b\n1,"' + long.replace('"', '""') + '"\n2,z\n\n\n3,"' + "\n" * 2000 + '"\n')
    got = {r[0]: r[1] for r in read_csv_records(small_splits, f"{tmp_dir}/in", null_tokens=None).collect()}
    assert got == {"1": long, "2": "z", "3": "\n" * 2000}


def test_csv_binding_and_malformed_records(small_splits, tmp_dir):
    write(f"{tmp_dir}/in/f.csv", "k,v\n" + "".join(f'{i},"x\n{i}"' + (",more" if i % 50 == 0 else "") + "\n" for i in range(1, 200)))
    bad = read_csv_records(small_splits, f"{tmp_dir}/in", {"number": "k", "value": "v"}, on_malformed="quarantine")
    assert bad.filter(f"{CORRUPT} is not null").count() == 3
    assert bad.filter(f"{CORRUPT} is null").select("number").distinct().count() == 196
    with pytest.raises(Exception, match="malformed CSV record"):
        read_csv_records(small_splits, f"{tmp_dir}/in", ["k", "v"]).collect()
    with pytest.raises(ValueError, match="not in the header"):
        read_csv_records(small_splits, f"{tmp_dir}/in", ["missing"])


def test_files_with_different_headers_are_an_error(small_splits, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", "k,v\n1,2\n")
    write(f"{tmp_dir}/in/b.csv", "k,w\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_records(small_splits, f"{tmp_dir}/in").collect()


def test_header_alone_and_unclosed_quotes(small_splits, tmp_dir):
    write(f"{tmp_dir}/a/f.csv", "k,v\n")
    assert read_csv_records(small_splits, f"{tmp_dir}/a").collect() == []
    write(f"{tmp_dir}/b/f.csv", 'k,v\n1,2\n3,"open\nto the end\n')
    assert split_records(small_splits, f"{tmp_dir}/b", CSV).count() == 3


def element(i, rng):
    return {"id": i, "a": field(rng), "n": {"x": [field(rng), {"y": field(rng)}]}} if i % 2 else {"id": i, "a": None}


@pytest.mark.parametrize("sep, indent, end", [(",", None, "]"), (",\n", 2, " ]\n"), (" , ", None, "\n]\n\n")])
def test_json_array_equals_the_whole_file_reader(small_splits, tmp_dir, sep, indent, end):
    rng = random.Random(indent or 1)
    for k in range(2):
        write(f"{tmp_dir}/in/f{k}.json", " [" + sep.join(json.dumps(element(i, rng), ensure_ascii=bool(i % 3), indent=indent) for i in range(300)) + end)
    path = f"{tmp_dir}/in"
    assert split_states(small_splits, path, JSON_ARRAY).groupBy("file").count().agg({"count": "min"}).first()[0] > 5
    got = read_json_array_records(small_splits, path, {"k": "id", "a": "a", "n": "n"}).collect()
    want = read_json_text(small_splits, path, {"k": "id", "a": "a", "n": "n"}).collect()

    def plain(rows):  # nested values are JSON text; its blanks differ
        return sorted(str((r.k, r.a, r.n and json.loads(r.n))) for r in rows)

    assert plain(got) == plain(want) and len(got) == 600


def test_json_odd_documents(small_splits, tmp_dir):
    write(f"{tmp_dir}/in/empty.json", "[]")
    write(f"{tmp_dir}/in/blank.json", " \n")
    write(f"{tmp_dir}/in/one.json", '[{"id":1,"a":"' + "x}\\\"{" * 2000 + '"}]')
    write(f"{tmp_dir}/in/deep.json", '[{"id":2,"a":' + '{"q":[' * 300 + "1" + "]}" * 300 + "}]")
    write(f"{tmp_dir}/in/cut.json", '[{"id":3,"a":"b"},{"id":4,')
    got = read_json_array_records(small_splits, f"{tmp_dir}/in", ["id", "a"], on_malformed="quarantine").collect()
    assert sorted(str(r.id) for r in got if r[CORRUPT] is None) == ["1", "2", "3"]
    assert [r[CORRUPT] for r in got if r[CORRUPT] is not None] == ['{"id":4,']
    assert next(r.a for r in got if r.id == "1") == 'x}"{' * 2000


def test_ingestion_in_splits_equals_the_default(small_splits, tmp_dir):
    rng = random.Random(8)
    csv_file(f"{tmp_dir}/c/f.csv", [(str(i), field(rng), "x") for i in range(200)], rng)
    write(f"{tmp_dir}/j/f.json", "[" + ",\n".join(json.dumps({"id": i, "a": field(rng)}) for i in range(200)) + "]\n")
    for fmt, folder, columns in (("csv", "c", ["id", "a", "b"]), ("json", "j", ["id", "a"])):
        one, two = (ingest_file(small_splits, fmt, f"{tmp_dir}/{folder}", f"{tmp_dir}/bronze-{fmt}-{form}", columns, "now",
                                json_array=form, csv_multiline=form) for form in (True, "split"))
        assert rows(one.bronze) == rows(two.bronze) and two.rows == 200
        assert two.records.first()["n"] == one.records.first()["n"] == 200
        assert all(r.passed for r in ingestion_checks(two.source, two.bronze, columns, records=two.records).collect())
