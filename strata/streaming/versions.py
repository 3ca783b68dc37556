"""Landing folders whose CSV files change their header from delivery to delivery.

Each run takes the files it has not seen (the stream's checkpoint remembers them), groups
them by header, reads every group by its own header and appends it under the columns' names.
A batch's files are written to folders named by the batch and the header, so a batch that is
repeated after a failure replaces itself. Reading merges the headers: a column that a file
lacks is null in its rows, and ``SCHEMA_VERSION`` tells under which header a row came.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import PANDAS_NA_TOKENS
from strata.sources.text_files import CORRUPT, checked, csv_header, null_tokens_to_null, surplus_fields, text_schema

SCHEMA_VERSION = "_schema_version"


def _by_header(spark: SparkSession, paths: list[str], multiline: bool) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. First lines are found in one job; a header that may span
    lines or hold quotes is read by the CSV reader."""
    first = (spark.read.text(paths).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                                           F.monotonically_increasing_id().alias("i"), "value")
                  .filter("b = 0 and value <> ''").groupBy("f").agg(F.min_by("value", "i").alias("line")).collect())
    lines: dict[str, list[str]] = {}
    for r in first:
        lines.setdefault(r["line"].rstrip("\r"), []).append(r["f"])
    out: dict[tuple[str, ...], list[str]] = {}
    for files in lines.values():
        out.setdefault(tuple(csv_header(spark, files[0], multiline)), []).extend(files)
    return out


def ingest_versions(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint_path: str, multiline: bool = True,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Take in what has landed since the last run and return the bronze table.

    Records with more fields than their file's header are an error; missing fields are null.
    """
    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # the paths of one batch of deliveries; their contents are not read here
        paths = [r["path"] for r in batch.select("path").collect()]
        groups = _by_header(session, paths, multiline) if paths else {}
        for header, files in sorted(groups.items()):
            df = (session.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", "PERMISSIVE")
                         .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
                         .schema(text_schema([*header, CORRUPT])).csv(files))
            df = null_tokens_to_null(checked(df, surplus_fields(len(header)), "CSV", "fail"), PANDAS_NA_TOKENS)
            version = hashlib.sha256("\x1f".join(header).encode()).hexdigest()[:12]
            (df.withColumn(SCHEMA_VERSION, F.lit(version)).write.mode("overwrite")
               .parquet(f"{bronze_path.rstrip('/')}/_batch={number}/_header={version}"))

    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (stream.load(landing_dir).select("path").writeStream.foreachBatch(take)
                   .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_versions(spark, bronze_path)


def read_versions(spark: SparkSession, bronze_path: str) -> DataFrame:
    """All batches under all columns that any of them has."""
    return spark.read.option("mergeSchema", True).parquet(bronze_path).drop("_batch", "_header")


def schema_versions(bronze: DataFrame) -> DataFrame:
    """``(_schema_version, n_rows, <one flag per column>)``: which columns each header fills."""
    columns = [c for c in bronze.columns if c != SCHEMA_VERSION]
    return bronze.groupBy(SCHEMA_VERSION).agg(F.count(F.lit(1)).alias("n_rows"),
                                              *[(F.count(f"`{c}`") > 0).alias(f"has_{c}") for c in columns])
