"""Dense surrogate ids (``row_number() over (order by …)``) without a single-partition window.

Two passes over range-partitioned data:

1. range-partition and sort by the order keys, tag each row with its partition
   index and position (``monotonically_increasing_id`` packs both), and cut the
   lineage with a reliable ``checkpoint()`` so both passes see identical partitions
   even if executors are lost or AQE re-plans;
2. count rows per partition (one row per partition — its size is bounded by the
   partition count, so broadcasting it is safe), turn the counts into offsets and
   add them to the positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions._util import as_col
from strata.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position


def dense_ids(df: DataFrame, order: Sequence, out: str = "id", start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based rank of each row in ``order`` (ascending, NULLS LAST).

    Rows equal on ``order`` get consecutive ids in an unspecified order; all other
    columns are appended as tie-breaks, so only identical rows are interchangeable
    (and even a group of millions of identical rows is spread over partitions).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sort_keys = [as_col(o).asc_nulls_last() for o in order]
    sort_keys += [F.col(c).asc_nulls_last() for c in df.columns]
    # Final tie-break: the row's position in the input. It only orders identical
    # rows (interchangeable), but lets the range partitioner split a hot group of
    # copies over many partitions instead of sending it to one task.
    sort_keys.append(F.col("_seq").asc())
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.withColumn("_seq", F.monotonically_increasing_id())
                .repartitionByRange(n, *sort_keys)
                .sortWithinPartitions(*sort_keys)
                .withColumn("_mid", F.monotonically_increasing_id())
                .drop("_seq")
                .checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    tagged = tagged.withColumn("_part", part).withColumn("_pos", pos)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # Global window over one row per partition: bounded by the partition count.
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
                  .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + F.lit(start))
                  .drop("_mid", "_part", "_pos", "_off"))
