"""Surrogate ids that stay the same from load to load.

A key map is a table ``(natural key columns, id)`` that only grows: keys already mapped keep
their id, new ones get the dense ids after the largest one so far. A load reads the map's
keys for an anti-join and numbers the new keys alone; on a load without news nothing is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.keys import dense_ids


def new_keys(keys: DataFrame, key_map: DataFrame | None, columns: Sequence[str], out: str = "id") -> DataFrame:
    """``(columns, out)`` of the keys that the map does not hold yet, numbered densely in the
    order of ``columns`` after the map's largest id. Null is a key value like others."""
    fresh = keys.select(*columns).distinct()
    start = 1
    if key_map is not None:
        known = key_map.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
        same = reduce(lambda a, b: a & b, [fresh[c].eqNullSafe(known[f"_k_{c}"]) for c in columns])
        fresh = fresh.join(known, same, "left_anti")
        start += key_map.agg(F.max(out)).first()[0] or 0
    return dense_ids(fresh, list(columns), out, start)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table stands at ``path`` (its commit marker is there)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_key_map(keys: DataFrame, path: str, columns: Sequence[str], out: str = "id") -> DataFrame:
    """The map at ``path`` extended by the load's new keys (appended) and read back.

    One writer at a time. A load that is repeated adds nothing, so a failed job is run again.
    """
    spark = keys.sparkSession
    known = spark.read.parquet(path) if table_exists(spark, path) else None
    fresh = new_keys(keys, known, columns, out)
    if known is None or not fresh.isEmpty():
        fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def with_key(df: DataFrame, key_map: DataFrame, columns: Sequence[str], out: str = "id") -> DataFrame:
    """``df`` with the ids of its keys (null-safe; a key that was never loaded has none)."""
    ids = key_map.select(*[F.col(c).alias(f"_k_{c}") for c in columns], F.col(out))
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(ids[f"_k_{c}"]) for c in columns])
    return df.join(ids, same, "left").drop(*[f"_k_{c}" for c in columns])
