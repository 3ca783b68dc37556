"""Profiling reports that surface defects in raw (bronze) data.

All reports aggregate before they shuffle; none collects a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions._util import as_col
from strata.functions.casts import ISO_LIKE

# Format classes of a date-like text value, tested in this order.
DATE_FORMAT_CLASSES = (
    ("iso", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("iso_with_time", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T]"),
    ("year_first_slash", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"),
    ("day_first_slash", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
)


def date_format_class(c, classes=DATE_FORMAT_CLASSES) -> "F.Column":
    col = F.trim(as_col(c))
    expr = F.when(as_col(c).isNull(), F.lit("null"))
    for name, pattern in classes:
        expr = expr.when(F.regexp_like(col, F.lit(pattern)), F.lit(name))
    return expr.otherwise(F.lit("other"))


def mixed_formats(df: DataFrame, column: str) -> DataFrame:
    """How many values of ``column`` fall in each date-format class."""
    return (df.groupBy(date_format_class(column).alias("format_class"))
              .agg(F.count(F.lit(1)).alias("n_values")))


def values_with(df: DataFrame, column: str, substring: str = "/") -> DataFrame:
    """Frequency of the values containing ``substring`` (e.g. day-first dates)."""
    return (df.filter(F.col(column).contains(substring))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def duplicate_keys(df: DataFrame, key: str, count_name: str = "n_copies") -> DataFrame:
    """Keys present more than once (a NULL key is a group too)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
              .filter(F.col(count_name) > 1))


def missing_ids(df: DataFrame, key: str) -> DataFrame:
    """Rows whose identifier is NULL or empty."""
    col = F.col(key)
    return df.filter(col.isNull() | (col == F.lit("")))


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None, select: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row (``LEFT JOIN … WHERE parent IS NULL``)."""
    parent_key = parent_key or child_key
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    out = child.join(keys, child[child_key] == keys["_pk"], "left_anti")
    return out.select(*select) if select else out


def spelling_variants(df: DataFrame, key, label: str, key_name: str = "key") -> DataFrame:
    """Keys written with more than one spelling: ``(key, spelling, n_rows, n_spellings)``.

    Counted per (key, spelling) first (partial aggregation); the spellings per key
    are then counted by a second aggregate and joined back on the key — no window,
    so a key with very many spellings is never handled by a single task (AQE
    splits a skewed join partition).
    """
    per = (df.groupBy(as_col(key).alias(key_name), F.col(label).alias("spelling"))
             .agg(F.count(F.lit(1)).alias("n_rows")))
    many = (per.groupBy(F.col(key_name).alias("_k"))
               .agg(F.count(F.lit(1)).alias("n_spellings"))
               .filter(F.col("n_spellings") > 1))
    return per.join(many, F.col(key_name).eqNullSafe(F.col("_k"))).select(
        key_name, "spelling", "n_rows", "n_spellings")


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per column: type and non-NULL count before and after a layer.

    Types come from the two schemas (metadata); the counts from one aggregate per
    side. Columns present on one side only get NULLs on the other (full outer join).
    """

    def side(df: DataFrame, suffix: str) -> DataFrame:
        cols = df.columns
        counts = df.agg(*[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
        rows = [F.struct(F.lit(c).alias("column_name"),
                         F.lit(df.schema[c].dataType.simpleString()).alias(f"type_{suffix}"),
                         F.col(f"_c{i}").cast("bigint").alias(f"nonnull_{suffix}"))
                for i, c in enumerate(cols)]
        return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")

    return side(before, "before").join(side(after, "after"), "column_name", "full")


def profile_summary(cases: DataFrame, districts: DataFrame, classes: DataFrame,
                    case_key: str = "case_id", open_col: str = "opened",
                    district_key: str = "district_id", class_key: str = "class_id",
                    class_label: str = "class_name") -> DataFrame:
    """One row per defect check on raw tables: ``(check_name, findings)``.

    non-ISO open dates, duplicated case keys, missing case ids, cases pointing at an
    unknown district, class keys written more than one way. Each check is a small
    aggregate (one row); the union is the report.
    """
    def one(name: str, df: DataFrame, count: "F.Column") -> DataFrame:
        return df.agg(count.cast("bigint").alias("findings")).select(
            F.lit(name).alias("check_name"), "findings")

    fmt = date_format_class(open_col)
    parts = [
        one("non_iso_dates", cases, F.count(F.when(~fmt.isin("iso", "null"), F.lit(1)))),
        one("duplicated_keys", duplicate_keys(cases, case_key), F.count(F.lit(1))),
        one("missing_ids", missing_ids(cases, case_key), F.count(F.lit(1))),
        one("orphan_references", orphans(cases, districts, district_key), F.count(F.lit(1))),
        one("spelling_variants",
            spelling_variants(classes, class_key, class_label, key_name="_key").select("_key")
            .distinct(), F.count(F.lit(1))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
