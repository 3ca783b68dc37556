"""Sources → bronze: read raw extracts as text, stamp, write Parquet.

Only technical work happens here (text columns, the ingestion stamp); typing and
cleaning belong to silver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.constants import INGESTED_AT
from strata.sinks.writers import batch_timestamp, write_bronze
from strata.sources.split_records import count_split_records, read_csv_records, read_json_array_records
from strata.sources.text_files import Columns, count_records, read_csv_text, read_json_text

#: Value of the switches ``json_array`` and ``csv_multiline`` that reads such files in splits.
SPLITS = "split"


@dataclass
class Ingested:
    name: str
    source: DataFrame   # the raw extract as read (text)
    bronze: DataFrame   # the written bronze table, read back
    rows: int           # rows written (observed during the write)
    path: str
    records: DataFrame | None = None  # (n): records counted on the raw text


def read_source(spark: SparkSession, fmt: str, path: str, columns: Columns | None = None,
                json_array: bool | str = True, csv_multiline: bool | str = True,
                on_malformed: str = "fail") -> DataFrame:
    if fmt == "csv" and csv_multiline == SPLITS:
        return read_csv_records(spark, path, columns, on_malformed=on_malformed)
    if fmt == "json" and json_array == SPLITS:
        if columns is None:
            raise ValueError("a JSON array read in splits needs its keys named")
        return read_json_array_records(spark, path, columns, on_malformed=on_malformed)
    if fmt == "csv":
        return read_csv_text(spark, path, columns, multiline=csv_multiline, on_malformed=on_malformed)
    if fmt == "json":
        return read_json_text(spark, path, columns, array=json_array, on_malformed=on_malformed)
    raise ValueError(f"unsupported source format {fmt!r}")


def ingest_file(spark: SparkSession, fmt: str, source_path: str, bronze_path: str,
                columns: Columns | None = None, batch_ts: str | None = None,
                json_array: bool | str = True, csv_multiline: bool | str = True,
                name: str | None = None, on_malformed: str = "fail") -> Ingested:
    """Ingest one extract into bronze and hand back both sides for checks."""
    src = read_source(spark, fmt, source_path, columns, json_array, csv_multiline, on_malformed)
    rows = write_bronze(src, bronze_path, batch_ts)
    in_splits = SPLITS in ((csv_multiline,) if fmt == "csv" else (json_array,))
    records = (count_split_records(spark, fmt, source_path) if in_splits else
               count_records(spark, fmt, source_path, json_array, csv_multiline))
    return Ingested(name or bronze_path.rsplit("/", 1)[-1], src,
                    spark.read.parquet(bronze_path), rows, bronze_path, records)


def ingest_all(spark: SparkSession, sources: Mapping[str, tuple[str, str]], bronze_dir: str,
               columns: Mapping[str, Columns] | None = None, json_array: bool | str = True,
               csv_multiline: bool | str = True) -> dict[str, Ingested]:
    """Ingest ``name → (format, path)`` in the given order into ``bronze_dir/<name>``.

    One batch timestamp per table call; the first failure stops the run. The two
    switches say what the files are: a JSON array document or JSON-lines, a CSV that may
    hold quoted newlines or one line a record. The first kinds are read by one task per
    file, or with the switch at ``"split"`` by as many as the file has splits.
    """
    out = {}
    for name, (fmt, path) in sources.items():
        out[name] = ingest_file(spark, fmt, path, f"{bronze_dir.rstrip('/')}/{name}",
                                (columns or {}).get(name), batch_timestamp(),
                                json_array=json_array, csv_multiline=csv_multiline, name=name)
    return out

