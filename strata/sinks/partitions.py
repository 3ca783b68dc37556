"""Upserts that rewrite only the partitions they touch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.extras import upsert_snapshot
from strata.session import scratch_dir


def _among(column: Column, values: list) -> Column:
    """``column`` is one of ``values``, null included; a filter that prunes partitions."""
    some = [v for v in values if v is not None]
    tests = ([column.isin(some)] if some else []) + ([column.isNull()] if None in values else [])
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def touched_partitions(current: DataFrame, updates: DataFrame, key: str, partition: str) -> list:
    """Partitions that a batch changes: where its rows go, and where rows of its keys are now
    (a row may move). One value per partition comes to the driver; of the table only the
    key and the partition are read."""
    keys = updates.select(F.col(key).alias("_k")).distinct()
    now = current.select(key, partition).join(keys, F.col(key).eqNullSafe(F.col("_k")), "left_semi").select(partition)
    kind = current.schema[partition].dataType
    rows = updates.select(F.col(partition).cast(kind).alias(partition)).unionByName(now).distinct().collect()
    return [r[0] for r in rows]


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, key: str, version_col: str, partition: str) -> list:
    """Apply a batch to the table at ``path`` (partitioned by ``partition``): per key the newest
    row by ``version_col`` wins, as in ``upsert_snapshot``. Returns the touched partitions.

    Files of other partitions stay as they are. The new content is written aside first, so the
    lineage ends before what it was read from is overwritten; if the job dies, running it again
    gives the same table. Partitions that lose their last row are removed. One writer at a time.
    """
    current = spark.read.parquet(path)
    updates = updates.select(*current.columns)
    touched = touched_partitions(current, updates, key, partition)
    if not touched:
        return []
    aside = scratch_dir(spark, "upsert")
    old = current.filter(_among(F.col(partition), touched))
    upsert_snapshot(old, updates, key, version_col).select(*current.columns).write.parquet(aside)
    fresh = spark.read.schema(current.schema).parquet(aside)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    left = {r[0] for r in fresh.select(partition).distinct().collect()}
    for value in touched:
        if value not in left:
            _remove_partition(spark, path, partition, value)
    return touched


def _remove_partition(spark: SparkSession, path: str, partition: str, value) -> None:
    """Remove the files of one partition, found by reading it (so names are not spelt here)."""
    folder = (spark.read.parquet(path).filter(_among(F.col(partition), [value]))
                   .select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f")).limit(1).collect())
    for r in folder:
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r["f"]))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
