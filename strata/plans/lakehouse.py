"""End to end: raw extracts → bronze → silver → gold → quality report.

The order is the dependency order; each layer is written and the next layer
reads the written files (lineage is cut at every layer).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import INGESTED_AT, STATUS_CLOSED, STATUS_OPEN
from strata.operators import quality as Q
from strata.plans.ingest import Ingested, ingest_all
from strata.functions import safe_int
from strata.plans.medallion import build_medallion
from strata.session import apply_sizes, input_bytes
from strata.sources.text_files import Columns
from strata.streaming.bronze_stream import EXTRACT

ROLES = ("cases", "districts", "classes", "events")


def _cols(*tests_by_column):
    return [{"name": name, "tests": list(tests)} for name, *tests in tests_by_column]


def default_rule_spec(statuses: Sequence[str] = (STATUS_CLOSED, STATUS_OPEN)) -> dict:
    """The model's twenty column tests (ten on silver, ten on gold), declared."""
    rel = lambda to, field: {"relationships": {"to": f"ref('{to}')", "field": field}}
    return {"models": [
        {"name": "stg_cases", "columns": _cols(
            ("case_id", "not_null", "unique"), ("opened", "not_null"),
            ("status", {"accepted_values": {"values": list(statuses)}}))},
        {"name": "stg_districts", "columns": _cols(("district_id", "not_null", "unique"))},
        {"name": "stg_classes", "columns": _cols(("class_id", "not_null", "unique"))},
        {"name": "stg_events", "columns": _cols(("case_id", "not_null"),
                                                ("event_date", "not_null"))},
        {"name": "fact_cases", "columns": _cols(
            ("case_id", "not_null", "unique"),
            ("district_id", rel("dim_district", "district_id")),
            ("class_id", rel("dim_class", "class_id")))},
        {"name": "dim_district", "columns": _cols(("district_id", "not_null", "unique"))},
        {"name": "dim_class", "columns": _cols(("class_id", "not_null", "unique"))},
        {"name": "dim_calendar", "columns": _cols(("cal_date", "not_null", "unique"))},
    ]}


def default_rules(statuses: Sequence[str] = (STATUS_CLOSED, STATUS_OPEN)) -> list[Q.Rule]:
    """The model's twenty column rules (ten on silver, ten on gold)."""
    return Q.rules_from_spec(default_rule_spec(statuses))


@dataclass
class Lakehouse:
    bronze: dict[str, Ingested]
    tables: dict[str, DataFrame]
    quality: DataFrame


DEFAULT_COLUMNS = {
    "cases": ["case_id", "class_id", "district_id", "court_id", "opened", "closed", "status"],
    "districts": ["district_id", "district_name", "uf"],
    "classes": ["class_id", "class_name"],
    "events": ["case_id", "event_type", "event_date"],
}


#: The key of each role's rows; of a key the rows of the newest extract count.
KEYS = {"cases": "case_id", "districts": "district_id", "classes": "class_id"}


def newest_per_key(bronze: DataFrame, key: str, extract: str = EXTRACT) -> DataFrame:
    """Rows of the newest extract (a file or a folder) that has their key (all of them: one extract may
    hold a key in several spellings). Rows without a readable key are kept.

    The newest extract per key is a partially aggregated maximum, joined back on the key.
    """
    keyed = bronze.withColumn("_key", safe_int(key, "bigint"))
    newest = keyed.groupBy("_key").agg(F.max(extract).alias("_newest")).filter(F.col("_key").isNotNull())
    return (keyed.join(newest, "_key", "left")
                 .filter(F.col("_key").isNull() | (F.col(extract) == F.col("_newest"))).drop("_key", "_newest"))


def land_incremental(spark: SparkSession, sources: Mapping[str, tuple[str, str]], root: str,
                     columns: Mapping[str, Columns] | None = None, json_array: bool | str = True,
                     csv_multiline: bool | str = True, extract_folders: bool = False) -> dict[str, DataFrame]:
    """Land every role's landing folder into bronze with the streaming ingestion
    (only files not seen before are read; the checkpoints live under ``root``)."""
    from strata.streaming import ingest_available

    cols = dict(DEFAULT_COLUMNS, **(columns or {}))
    out = {}
    for role in ROLES:
        if role not in sources:
            continue
        fmt, path = sources[role]
        out[role] = ingest_available(spark, fmt, path, cols[role],
                                     f"{root.rstrip('/')}/bronze/{role}",
                                     f"{root.rstrip('/')}/_checkpoints/{role}",
                                     json_array=json_array, csv_multiline=csv_multiline, extract_folders=extract_folders)
    return out


def build_lakehouse(spark: SparkSession, sources: Mapping[str, tuple[str, str]], root: str,
                    columns: Mapping[str, Columns] | None = None, today=None,
                    rules: Sequence[Q.Rule] | None = None, incremental: bool = False,
                    json_array: bool | str = True, csv_multiline: bool | str = True, extract_folders: bool = False) -> Lakehouse:
    """``sources`` maps each role (cases, districts, classes, events) to
    ``(format, path)``; layers are written under ``root/bronze`` and ``root/model``.

    ``columns`` maps a role's model columns to the names in its extract (or lists them if
    they are the same); binding is by name, whatever the order.

    ``incremental`` treats each path as a landing folder of snapshots: new extracts are
    appended to bronze by the streaming ingestion, then silver and gold are rebuilt from
    the newest rows of every key (events: from all of them, distinct).
    ``json_array`` / ``csv_multiline``: set False for JSON-lines and single-line CSV
    so large extracts split across tasks, or ``"split"`` to read arrays and quoted line ends
    in splits. ``extract_folders``: a snapshot is a folder of files
    in its landing folder, newest by name, instead of one file. Splits and shuffles are sized from the extracts.
    """
    apply_sizes(spark, input_bytes(spark, [path for _, path in sources.values()]))
    bronze: dict[str, Ingested] = {}
    if incremental:
        landed = land_incremental(spark, sources, root, columns, json_array, csv_multiline, extract_folders)
        frames = {r: (newest_per_key(df, KEYS[r]) if r in KEYS else df).drop(INGESTED_AT, EXTRACT)
                  for r, df in landed.items()}
    else:
        names = dict(DEFAULT_COLUMNS, **(columns or {}))
        bronze = ingest_all(spark, {r: sources[r] for r in ROLES if r in sources},
                            f"{root.rstrip('/')}/bronze", names, json_array, csv_multiline)
        frames = {r: bronze[r].bronze.drop(INGESTED_AT) for r in bronze}
    tables = build_medallion(frames, f"{root.rstrip('/')}/model", today=today, quarantine=True)
    quality = Q.run_suite(tables, list(rules) if rules is not None else default_rules())
    return Lakehouse(bronze, tables, quality)


def open_lakehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The written silver and gold tables of a built lakehouse."""
    from strata.plans.medallion import GOLD, SILVER

    base = f"{root.rstrip('/')}/model"
    tables = {name: spark.read.parquet(f"{base}/{name}") for name in SILVER}
    tables.update({name: spark.read.parquet(f"{base}/{name}")
                   for name in ("dim_calendar", "fact_cases")})
    tables["dim_district"] = tables["stg_districts"]
    tables["dim_class"] = tables["stg_classes"]
    assert set(GOLD) <= set(tables)
    return tables
