"""File-level audit: on-disk size per format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file_path, file_size)`` of every file under ``path``.

    ``binaryFile`` without its ``content`` column only lists files — file bodies are
    never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("file_path"),
                                    F.col("length").alias("file_size"))


def file_sizes(spark: SparkSession, locations: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Total bytes and file count per ``label → (format, path)``."""
    parts = []
    for label, (fmt, path) in locations.items():
        glob = "*.parquet" if fmt == "parquet" else ("*.csv" if fmt == "csv" else None)
        parts.append(list_files(spark, path, glob)
                     .select(F.lit(label).alias("dataset"), F.lit(fmt).alias("format"),
                             "file_path", "file_size"))
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return files.groupBy("dataset", "format").agg(
        F.sum("file_size").cast("bigint").alias("bytes"),
        F.count(F.lit(1)).alias("n_files"))

