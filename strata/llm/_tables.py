"""Written intermediate tables and session settings of the llm operators."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

#: Rows per Arrow batch: texts are long, so batches are kept small.
BATCH_ROWS = 1024


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small unless the session already names a size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


_SCOPES = threading.local()


@contextmanager
def passing_tables(spark: SparkSession):
    """A scope whose written tables go when it ends. What outlives it must not read them: its
    result is written with ``outlives=True``, so it lands outside the scope."""
    open_ = _SCOPES.__dict__.setdefault("roots", [])
    root = scratch_dir(spark, "passing")
    open_.append(root)
    try:
        yield
    finally:
        open_.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, compression: str = "snappy", outlives: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends
    there, so a lost executor never recomputes (or re-randomises) what came before.
    Inside ``passing_tables`` the table lives as long as the scope (``outlives``: the one around it)."""
    spark = df.sparkSession
    roots = _SCOPES.__dict__.get("roots", [])
    roots = roots[:-1] if outlives else roots
    path = f"{roots[-1]}/{label}-{uuid.uuid4().hex[:12]}" if roots else scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def partition_id() -> int:
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx is not None else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def most_frequent(df: DataFrame, count_col: str, n: int) -> DataFrame:
    """At most ``n`` rows with the largest counts, without a sort.

    Counts fall into levels of 1/8 power of two; levels are taken from the top while their
    rows fit, so rows of one level come all or not at all. Only the histogram (a few
    hundred numbers) reaches the driver, whatever the number of rows or partitions.
    """
    level = F.floor(F.log2(F.col(count_col)) * 8).cast("int")
    sizes = df.filter(F.col(count_col) > 0).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    total, cut = 0, None
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["rows"]
        if total > n:
            break
        cut = r["level"]
    return df.filter(level >= cut) if cut is not None else df.limit(0)


#: Bits of a ``key_filter`` as a power of two: 4 MB, whatever the number of keys.
FILTER_BITS = 25


def key_filter(keys: DataFrame, col: str) -> np.ndarray:
    """Bloom filter of well-mixed 64-bit keys with two bits a key, made on the executors.

    At most 4 MB reach the driver. More keys let more others through, so what passes must
    still meet the keys in a join.
    """
    mask = (1 << FILTER_BITS) - 1
    k = F.col(col)
    bits = keys.filter(k.isNotNull()).select(F.explode(F.array(k.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(k, 64 - FILTER_BITS))).alias("b"))
    rows = bits.groupBy(F.floor(F.col("b") / 32768).alias("at")).agg(F.bitmap_construct_agg(F.col("b") % 32768).alias("m")).collect()
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for r in rows:
        out[r["at"] * 4096:(r["at"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys pass the filter: all that are in it, and few others."""
    k = keys.view(np.uint64)

    def at(b):
        return (bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 != 0

    return at(k & np.uint64((1 << FILTER_BITS) - 1)) & at(k >> np.uint64(64 - FILTER_BITS))
