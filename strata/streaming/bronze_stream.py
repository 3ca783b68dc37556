"""Incremental bronze ingestion with Structured Streaming.

The same text-faithful ingestion as ``strata.plans.ingest``, but for a landing
folder that keeps receiving extracts: every run picks up only files it has not
seen (the checkpoint remembers them), stamps each micro-batch with its own
instant and appends through the Parquet file sink, whose commit log makes the
output exactly-once even when a batch is retried after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.constants import INGESTED_AT, PANDAS_NA_TOKENS
from strata.sources.text_files import (CORRUPT, Columns, checked, column_mapping, csv_header, null_tokens_to_null,
                                       renamed, surplus_fields, text_schema, unreadable_json)

EXTRACT = "_extract"
UTC_CLOCK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_landing(spark: SparkSession, fmt: str, landing_dir: str, columns: Columns,
                 json_array: bool = True, csv_multiline: bool = True,
                 max_files_per_trigger: int | None = None, extract_folders: bool = False) -> DataFrame:
    """Streaming text read of a landing folder, every column a string, bound by name.

    The header of the files that have landed fixes the CSV columns; a later file with
    another header, a record with surplus fields and unreadable JSON fail the batch.
    ``EXTRACT`` orders the extracts: modification time, then name, of a row's file. With
    ``extract_folders`` an extract is a folder of any number of files inside the landing
    folder, and the folders' names order them.
    """
    mapping = column_mapping(columns)
    json_array, csv_multiline = bool(json_array), bool(csv_multiline)  # a stream reads such files whole
    reader = (spark.readStream.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                   .option("recursiveFileLookup", extract_folders))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    extract = F.concat(F.date_format("_metadata.file_modification_time", UTC_CLOCK), F.lit(" "),
                       F.col("_metadata.file_name"))
    if extract_folders:
        # the last folder, cut at slashes: a pattern tried at every place of the path costs more than the record
        extract = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    extract = extract.alias(EXTRACT)
    if fmt == "csv":
        header = csv_header(spark, landing_dir, csv_multiline, recursive=extract_folders)
        missing = [c for c in mapping.values() if c not in header]
        if missing:
            raise ValueError(f"columns {missing} are not in the header {header} of {landing_dir}")
        df = (reader.schema(text_schema([*header, CORRUPT])).option("header", True).option("enforceSchema", False)
              .option("multiLine", csv_multiline).option("escape", '"').csv(landing_dir)).select("*", extract)
        df = renamed(checked(df, surplus_fields(len(header)), "CSV", "fail"), mapping)
        return null_tokens_to_null(df, PANDAS_NA_TOKENS, [c for c in df.columns if c != EXTRACT])
    if fmt == "json":
        names = list(mapping.values())
        df = (reader.schema(text_schema([*names, CORRUPT])).option("multiLine", json_array).json(landing_dir)
              .select("*", extract))
        return renamed(checked(df, unreadable_json(names), "JSON", "fail"), mapping)
    raise ValueError(f"unsupported source format {fmt!r}")


def stamp_batches(df: DataFrame, stamp: str = INGESTED_AT) -> DataFrame:
    """Add the ingestion instant as ISO-8601 UTC text (``…+00:00``, the batch stamp's
    shape). In a streaming query ``current_timestamp`` is fixed per micro-batch, so
    every row of a batch carries the same stamp; it is shifted from the session time
    zone to UTC before rendering."""
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    utc = F.to_utc_timestamp(F.current_timestamp(), tz)
    return df.withColumn(stamp, F.concat(F.date_format(utc, UTC_CLOCK), F.lit("+00:00")))


def start_bronze_stream(spark: SparkSession, fmt: str, landing_dir: str, columns: Columns,
                        bronze_path: str, checkpoint_path: str, available_now: bool = True,
                        processing_time: str | None = None, **read_options) -> StreamingQuery:
    """Start the ingestion query.

    ``available_now`` processes everything that has landed and stops (a scheduled
    incremental batch); otherwise it runs continuously with ``processing_time``
    triggers.
    """
    stream = stamp_batches(read_landing(spark, fmt, landing_dir, columns, **read_options))
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", bronze_path).option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, fmt: str, landing_dir: str, columns: Columns,
                     bronze_path: str, checkpoint_path: str, **read_options) -> DataFrame:
    """Run one incremental pass to completion and return the bronze table."""
    q = start_bronze_stream(spark, fmt, landing_dir, columns, bronze_path, checkpoint_path,
                            available_now=True, **read_options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(bronze_path)
