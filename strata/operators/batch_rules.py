"""Column rules on a batch of new rows against a large history.

The full rules group the whole history. Here a bit table of the batch's keys, of a size that
follows the batch and is bounded, is broadcast to the history scan; only history rows whose
key may be in the batch leave their task, and an exact join settles them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bucket, and the largest table as a power of two of bits (16 MB).
_BUCKET, _MOST = 15, 27


def _hash(col: str, bits: int) -> F.Column:
    return F.xxhash64(F.col(col)).bitwiseAND(F.lit((1 << bits) - 1))


def key_bits(keys: DataFrame, col: str, bits: int) -> DataFrame:
    """``(bucket, bits)``: the hashes of the keys, one bit each, in buckets of 4 KB."""
    h = _hash(col, bits)
    return (keys.filter(F.col(col).isNotNull()).groupBy(F.shiftright(h, _BUCKET).alias("_bucket"))
                .agg(F.bitmap_construct_agg(h.bitwiseAND(F.lit((1 << _BUCKET) - 1))).alias("_bits")))


def may_match(history: DataFrame, keys: DataFrame, key: str, batch_key: str | None = None, batch_rows: int | None = None) -> DataFrame:
    """History rows whose ``key`` may be one of ``keys``: all that are, and about one in
    sixteen of the others at most (more when a batch outgrows the largest table)."""
    batch_key = batch_key or key
    n = keys.count() if batch_rows is None else batch_rows
    bits = max(_BUCKET, min(_MOST, (16 * max(1, n)).bit_length()))
    table = F.broadcast(key_bits(keys, batch_key, bits))  # at most 16 MB
    h = _hash(key, bits)
    place = h.bitwiseAND(F.lit((1 << _BUCKET) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1
    known = history.filter(F.col(key).isNotNull()).withColumn("_at", F.shiftright(h, _BUCKET))
    return known.join(table, known["_at"] == table["_bucket"]).filter(hit).drop("_at", "_bucket", "_bits")


def unique_violations(history: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``(key, n_history, n_batch)`` of the keys that occur more than once because of the
    batch: together more than once, in the history at most once. Added to what the history
    violated before, this is the full ``unique`` rule over both. Null keys pass."""
    own = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_batch"))
    near = may_match(history.select(key), own.select(key), key)
    old = near.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n_history"))
    both = own.join(old, own[key] == old["_k"], "left").withColumn("n_history", F.coalesce("n_history", F.lit(0)).cast("bigint"))
    return both.filter((F.col("n_history") <= 1) & (F.col("n_history") + F.col("n_batch") > 1)).select(key, "n_history", "n_batch")


def orphan_rows(batch: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """``(key, n_rows)`` of the batch's keys without a parent row, as the ``relationships``
    rule counts them. Null keys pass."""
    parent_key = parent_key or key
    own = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    near = may_match(parents.select(F.col(parent_key).alias("_p")), own.select(F.col(key).alias("_p")), "_p")
    return own.join(near.distinct(), own[key] == F.col("_p"), "left_anti")


def rule_results(history: DataFrame, batch: DataFrame, key: str, parents: DataFrame, parent_key: str, known_violations: int = 0) -> DataFrame:
    """``(rule, violations, passed)`` for ``unique`` over history and batch, and for the batch's
    ``relationships``; ``known_violations``: what the history violated before."""
    dup = unique_violations(history, batch, key).agg((F.count(F.lit(1)) + known_violations).alias("violations")).select(F.lit("unique").alias("rule"), "violations")
    lost = orphan_rows(batch, parents, parent_key).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("violations"))
    return dup.unionByName(lost.select(F.lit("relationships").alias("rule"), "violations")).withColumn("passed", F.col("violations") == 0)
