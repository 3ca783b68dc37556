"""Writers for bronze, silver and gold tables."""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.constants import INGESTED_AT

log = logging.getLogger(__name__)


def batch_timestamp() -> str:
    """One UTC ISO-8601 instant per ingestion call, stamped on every row."""
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def write_bronze(df: DataFrame, path: str, batch_ts: str | None = None,
                 stamp: str = INGESTED_AT) -> int:
    """Stamp the ingestion instant (a text column), overwrite Parquet at ``path``.

    Returns the written row count, observed during the write itself (no second
    job over the data).
    """
    ts = batch_ts or batch_timestamp()
    obs = Observation(f"bronze_rows_{abs(hash(path))}")
    stamped = df.withColumn(stamp, F.lit(ts)).observe(obs, F.count(F.lit(1)).alias("rows"))
    stamped.write.mode("overwrite").parquet(path)
    rows = int(obs.get["rows"])
    log.info("bronze written: %s (%d rows)", path, rows)
    return rows


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """Full-refresh Parquet table (optionally partitioned, e.g. by year for a big fact)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tables(frames: dict[str, DataFrame], base_dir: str, parallel: int = 4,
                 writer=None) -> dict[str, DataFrame]:
    """Write independent tables as concurrent Spark jobs and return them read back.

    Each table is its own job; submitting them from a few threads lets small jobs
    share the executors instead of running back to back. ``writer(df, path)``
    defaults to an overwrite of Parquet at ``base_dir/<name>``.
    """
    from concurrent.futures import ThreadPoolExecutor

    def run(item):
        name, df = item
        path = f"{base_dir.rstrip('/')}/{name}"
        if writer is None:
            df.write.mode("overwrite").parquet(path)
        else:
            writer(df, path)
        return name, path

    spark = next(iter(frames.values())).sparkSession if frames else None
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(frames) or 1))) as pool:
        written = list(pool.map(run, frames.items()))
    return {name: spark.read.parquet(path) for name, path in written}


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Serve a written table under ``name`` for SQL consumers."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df
