"""Point-in-time join: each row gets the version of its key that was valid at its time.

Rows and versions are unioned and range-partitioned by (key, time), so a key with a third of
all rows is spread over as many partitions as its share asks for. Inside a partition the
latest version runs along; what a key's earlier partitions end with is carried over by a
window over one row per key and partition. No interval join, no window over a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def as_of_join(rows: DataFrame, versions: DataFrame, key: str, time: str, payload: Sequence[str],
               valid_from: str = "valid_from", valid_to: str | None = "valid_to",
               num_partitions: int | None = None) -> DataFrame:
    """``rows`` with the ``payload`` columns of the version valid at ``time``: the latest with
    ``valid_from <= time``, if ``time < valid_to`` (null: still valid).

    Rows without such a version, without a key or without a time keep null there. Of versions
    of a key that begin together the one with the largest payload counts. Payload names must
    not be columns of ``rows``.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    clash = set(payload) & set(rows.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in the rows already")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = F.struct(*[F.col(c) for c in payload], *([F.col(valid_to).alias("_until")] if valid_to else []))
    kind = rows.schema[key].dataType
    known = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    placed = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(time).alias("_t"), F.lit(1).alias("_o"), F.monotonically_increasing_id().alias("_s"), whole.alias("_row"))
    marks = known.select(F.col(key).cast(kind).alias("_k"), F.col(valid_from).cast(rows.schema[time].dataType).alias("_t"),
                         F.lit(0).alias("_o"), version.alias("_v"))
    both = placed.unionByName(marks, allowMissingColumns=True)
    order = ["_t", "_o", "_v", "_s"]  # versions first; equal ones by their payload, so the largest is last
    # Partition numbers must hold for both passes below, whatever is lost or planned anew.
    dealt = both.repartitionByRange(n, "_k", *order).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    run = Window.partitionBy("_part", "_k").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = F.last("_v", ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = dealt.groupBy("_k", "_part").agg(F.max(F.when(F.col("_o") == 0, F.struct("_t", "_v"))).alias("_e"))
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_k", "_part", F.last("_e", ignorenulls=True).over(before)["_v"].alias("_c"))
    found = (dealt.withColumn("_l", local).filter("_o = 1").join(carried, ["_k", "_part"])
                  .withColumn("_v", F.coalesce("_l", "_c")))
    valid = F.col("_v._until").isNull() | (F.col("_t") < F.col("_v._until")) if valid_to else F.lit(True)
    out = found.select("_row.*", *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in payload])
    rest = rows.filter(F.col(key).isNull() | F.col(time).isNull())
    return out.unionByName(rest.select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in payload]))
