"""Optional tier: improvements the modelled pipeline describes but does not apply.

quarantine instead of silent drops, an "unknown" dimension member instead of
dropping orphans, source lineage columns, open cases aged to a date, snapshot
upserts of an accumulating fact, type-2 history of a dimension, and drill-across
of two facts through a conformed dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import UNKNOWN_KEY, UNKNOWN_LABEL
from strata.functions._util import as_col

REJECT = "reject_reason"


# --- quarantine -------------------------------------------------------------------


def tag_rejects(df: DataFrame, checks: Sequence[tuple[str, Column]], out: str = REJECT) -> DataFrame:
    """Add ``out`` = the first failing check's reason (NULL when the row is clean).

    One pass: write the tagged frame once (e.g. partitioned by ``out IS NULL``) and
    both the clean table and the quarantine come out of the same job.
    """
    reason = None
    for name, bad in checks:
        cond = F.coalesce(bad, F.lit(False))
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    return df.withColumn(out, reason if reason is not None else F.lit(None).cast("string"))


def split_rejects(tagged: DataFrame, out: str = REJECT) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the reason column, quarantined rows with it)."""
    return tagged.filter(F.col(out).isNull()).drop(out), tagged.filter(F.col(out).isNotNull())


# --- unknown member -------------------------------------------------------------------


def with_unknown_member(dim: DataFrame, key: str, label_col: str, key_value=UNKNOWN_KEY,
                        label: str = UNKNOWN_LABEL) -> DataFrame:
    """The dimension plus one "unknown" row (other attributes NULL)."""
    member = dim.sparkSession.range(1).select(*[
        (F.lit(key_value).cast(f.dataType) if f.name == key else
         F.lit(label).cast(f.dataType) if f.name == label_col else
         F.lit(None).cast(f.dataType)).alias(f.name)
        for f in dim.schema.fields])
    return dim.unionByName(member)


def remap_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
                  key_value=UNKNOWN_KEY) -> DataFrame:
    """Point keys missing from the dimension (or NULL) at the unknown member, so the
    rows stay in every report instead of disappearing."""
    dim_key = dim_key or key
    known = dim.select(F.col(dim_key).alias("_known")).distinct()
    joined = fact.join(known, fact[key] == F.col("_known"), "left")
    return joined.withColumn(key, F.when(F.col("_known").isNull(), F.lit(key_value))
                             .otherwise(F.col(key)).cast(fact.schema[key].dataType)).drop("_known")


# --- lineage columns ---------------------------------------------------------------------


def with_lineage(df: DataFrame, columns: Sequence[str] | None = None,
                 file_col: str = "_source_file", hash_col: str = "_row_hash") -> DataFrame:
    """Source file (hidden ``_metadata`` column of a file scan) and a SHA-256 of the
    row's text (NULLs marked, separator-safe), computed by the scan's tasks."""
    cols = list(columns or [c for c in df.columns if not c.startswith("_")])
    return df.select("*", F.col("_metadata.file_path").alias(file_col),
                     row_hash(cols).alias(hash_col))


def row_hash(columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("␀")) for c in columns]
    return F.sha2(F.concat_ws("␟", *parts), 256)


# --- aged open cases --------------------------------------------------------------------------


def aged_duration_days(open_date, close_date, as_of) -> Column:
    """Days from open to close, or to ``as_of`` while open; NULL when negative."""
    o = as_col(open_date)
    end = F.coalesce(as_col(close_date), F.lit(as_of).cast("date"))
    return F.when(end >= o, F.datediff(end, o).cast("bigint"))


# --- accumulating snapshot upsert ---------------------------------------------------------------


def keep_latest(df: DataFrame, key: str | Sequence[str], recency: str) -> DataFrame:
    """One row per key: the most recent by ``recency`` (NULL oldest), ties broken by
    the largest remaining columns. A grouped ``max(struct)`` — combines map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    rest = [c for c in payload if c != recency]
    best = F.max(F.struct(F.col(recency).isNotNull().alias("_has"), F.col(recency).alias("_r"),
                          *[F.col(c).alias(f"_p_{c}") for c in rest]))
    out = df.groupBy(*keys).agg(best.alias("_b"))
    return out.select(*keys, F.col("_b._r").alias(recency),
                      *[F.col(f"_b._p_{c}").alias(c) for c in rest]).select(*df.columns)


def upsert_snapshot(current: DataFrame, updates: DataFrame, key: str, version_col: str) -> DataFrame:
    """Apply a batch of changed rows to an accumulating-snapshot table: for every key
    the row with the newest ``version_col`` wins.

    Rows whose key is not in the batch pass through an anti-join with the batch's keys;
    only the touched rows and the batch are grouped.
    """
    keys = updates.select(F.col(key).alias("_k")).distinct()
    same = current[key].eqNullSafe(keys["_k"])
    touched = current.join(keys, same, "left_semi").unionByName(updates)
    return current.join(keys, same, "left_anti").unionByName(keep_latest(touched, key, version_col))


# --- type-2 history ------------------------------------------------------------------------------


def scd2_history(snapshots: DataFrame, key: str, tracked: Sequence[str], as_of_col: str,
                 valid_from: str = "valid_from", valid_to: str = "valid_to",
                 current_col: str = "is_current") -> DataFrame:
    """Versions of each key from dated snapshots (one row per key and snapshot date).

    Consecutive snapshots with the same tracked values collapse into one version;
    ``valid_to`` is the next version's start (NULL for the current one). The
    windows run per key over that key's snapshot rows — one per snapshot date, so
    their size is bounded by the number of snapshots, not by the data.
    """
    h = F.sha2(F.concat_ws("␟", *[F.coalesce(F.col(c).cast("string"), F.lit("␀"))
                                        for c in tracked]), 256)
    rows = snapshots.select(key, *tracked, F.col(as_of_col).alias(valid_from), h.alias("_h"))
    w = Window.partitionBy(key).orderBy(valid_from)
    changes = (rows.withColumn("_prev", F.lag("_h").over(w))
                   .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("_h"))))
    return (changes.withColumn(valid_to, F.lead(valid_from).over(w))
                   .withColumn(current_col, F.col(valid_to).isNull())
                   .drop("_h", "_prev"))


def scd2_merge(history: DataFrame | None, snapshot: DataFrame, key: str, tracked: Sequence[str],
               as_of, valid_from: str = "valid_from", valid_to: str = "valid_to",
               current_col: str = "is_current") -> DataFrame:
    """Apply one dated snapshot to a type-2 history (the incremental form).

    Current versions whose tracked values changed are closed at ``as_of`` and a new
    version opens; keys seen for the first time open a version; everything else is
    kept. One full outer join of the current versions with the snapshot on the key
    (a shuffle on the key, no window), plus the closed versions passed through.
    """
    as_of_col = F.lit(as_of).cast("date")
    h = lambda prefix: F.sha2(F.concat_ws("␟", *[
        F.coalesce(F.col(f"{prefix}{c}").cast("string"), F.lit("␀")) for c in tracked]), 256)
    snap = snapshot.select(F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in tracked])
    opened = snap.select(F.col("_sk").alias(key),
                         *[F.col(f"_s_{c}").alias(c) for c in tracked],
                         as_of_col.alias(valid_from), F.lit(None).cast("date").alias(valid_to),
                         F.lit(True).alias(current_col))
    if history is None:
        return opened
    closed_before = history.filter(~F.col(current_col))
    current = history.filter(F.col(current_col))
    j = current.join(snap, current[key] == snap["_sk"], "full")
    changed = F.col(key).isNotNull() & F.col("_sk").isNotNull() & (h("") != h("_s_"))
    brand_new = F.col(key).isNull()
    kept = j.filter(F.col("_sk").isNull() | (F.col(key).isNotNull() & ~changed))
    cols = [key, *tracked, valid_from, valid_to, current_col]
    still = kept.select(*cols)
    closing = j.filter(changed).select(key, *tracked, valid_from, as_of_col.alias(valid_to),
                                       F.lit(False).alias(current_col))
    opening = (j.filter(changed | brand_new)
                .select(F.col("_sk").alias(key), *[F.col(f"_s_{c}").alias(c) for c in tracked],
                        as_of_col.alias(valid_from), F.lit(None).cast("date").alias(valid_to),
                        F.lit(True).alias(current_col)))
    return closed_before.select(*cols).unionByName(still).unionByName(closing).unionByName(opening)


# --- drill-across ------------------------------------------------------------------------------------


def drill_across(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine two facts already aggregated to the same conformed keys (full outer
    join on the keys; each side is one row per key combination)."""
    return left.join(right, list(keys), "full")
