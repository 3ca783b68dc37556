"""Bronze → silver → gold for the case-duration model, column-parameterised.

Silver: typing with lenient casts, mixed-date parsing, whole-row de-duplication,
title-cased names, preferred-spelling survivors. Gold: conformed dimensions, the
generated calendar and the fact at case grain with its duration measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import clean_code, parse_mixed_date, safe_int, strict_int, title_case
from strata.operators.calendar import calendar
from strata.operators.dedup import distinct_typed, keep_preferred, prefer_not_shouting
from strata.operators.star import build_fact

DATE_FORMATS = ("iso", "d/M/yyyy")


@dataclass(frozen=True)
class CaseCols:
    case_id: str = "case_id"
    class_id: str = "class_id"
    district_id: str = "district_id"
    court_id: str = "court_id"
    opened: str = "opened"
    closed: str = "closed"
    status: str = "status"


@dataclass(frozen=True)
class DistrictCols:
    district_id: str = "district_id"
    name: str = "district_name"
    uf: str = "uf"


@dataclass(frozen=True)
class ClassCols:
    class_id: str = "class_id"
    name: str = "class_name"


@dataclass(frozen=True)
class EventCols:
    case_id: str = "case_id"
    event_type: str = "event_type"
    event_date: str = "event_date"


def type_cases(bronze: DataFrame, c: CaseCols = CaseCols(), formats=DATE_FORMATS) -> DataFrame:
    """Typed projection of raw cases (no filtering, duplicates kept)."""
    return bronze.select(
        safe_int(c.case_id, "bigint").alias(c.case_id),
        safe_int(c.class_id, "int").alias(c.class_id),
        safe_int(c.district_id, "int").alias(c.district_id),
        safe_int(c.court_id, "int").alias(c.court_id),
        parse_mixed_date(c.opened, formats).alias(c.opened),
        parse_mixed_date(c.closed, formats).alias(c.closed),
        F.col(c.status),
    )


def silver_cases(bronze: DataFrame, c: CaseCols = CaseCols(), formats=DATE_FORMATS) -> DataFrame:
    """Typed, whole-row de-duplicated cases; rows without an id are dropped."""
    typed = distinct_typed(type_cases(bronze, c, formats))
    return typed.filter(F.col(c.case_id).isNotNull())


def quarantine_cases(bronze: DataFrame, stg_districts: DataFrame, c: CaseCols = CaseCols(),
                     d: DistrictCols = DistrictCols()) -> DataFrame:
    """Every raw row that silver or gold leave out, its text as it came, with the reason
    (``missing_id`` before ``unknown_district``) instead of a silent drop. Copies stay:
    the counts are those of the extract."""
    from strata.operators.extras import tag_rejects

    known = stg_districts.select(F.col(d.district_id).alias("_known")).distinct()
    typed = bronze.withColumn("_district", safe_int(c.district_id, "int"))
    joined = typed.join(known, F.col("_district") == F.col("_known"), "left")
    tagged = tag_rejects(joined, [("missing_id", safe_int(c.case_id, "bigint").isNull()),
                                  ("unknown_district", F.col("_known").isNull())]).drop("_known", "_district")
    return tagged.filter(F.col("reject_reason").isNotNull())


def silver_districts(bronze: DataFrame, c: DistrictCols = DistrictCols()) -> DataFrame:
    """Strict id, title-cased name, upper-cased state code. No de-duplication."""
    return bronze.select(strict_int(c.district_id, "int").alias(c.district_id),
                         title_case(c.name).alias(c.name),
                         clean_code(c.uf).alias(c.uf))


def silver_classes(bronze: DataFrame, c: ClassCols = ClassCols()) -> DataFrame:
    """One spelling per class id: a spelling that is not all upper case wins,
    ties broken by the spelling itself."""
    typed = bronze.select(strict_int(c.class_id, "int").alias(c.class_id), F.col(c.name))
    return keep_preferred(typed, c.class_id, prefer_not_shouting(c.name))


def silver_events(bronze: DataFrame, c: EventCols = EventCols(), formats=DATE_FORMATS) -> DataFrame:
    """Typed, whole-row de-duplicated events. Rows without a case id are kept
    (a not-null rule reports them)."""
    typed = bronze.select(safe_int(c.case_id, "bigint").alias(c.case_id),
                          F.col(c.event_type),
                          parse_mixed_date(c.event_date, formats).alias(c.event_date))
    return distinct_typed(typed)


def gold(stg_cases: DataFrame, stg_districts: DataFrame, stg_classes: DataFrame,
         c: CaseCols = CaseCols(), d: DistrictCols = DistrictCols(), today=None,
         bounds: str = "reference") -> dict[str, DataFrame]:
    """Dimensions, calendar and fact from the silver tables."""
    return {
        "dim_district": stg_districts,
        "dim_class": stg_classes,
        "dim_calendar": calendar(stg_cases, c.opened, c.closed, today=today, bounds=bounds),
        "fact_cases": build_fact(stg_cases, stg_districts, c.district_id, c.opened, c.closed,
                                 dim_key=d.district_id),
    }


def medallion(bronze: dict[str, DataFrame], today=None) -> dict[str, DataFrame]:
    """Every silver and gold table from the four bronze tables
    (``cases``, ``districts``, ``classes``, ``events``). Without an events extract
    the events tables are empty (the case model does not depend on them)."""
    if "events" not in bronze:
        from strata.sources.text_files import text_schema

        c = EventCols()
        bronze = dict(bronze, events=bronze["cases"].sparkSession.createDataFrame(
            [], text_schema([c.case_id, c.event_type, c.event_date])))
    silver = {
        "stg_cases": silver_cases(bronze["cases"]),
        "stg_districts": silver_districts(bronze["districts"]),
        "stg_classes": silver_classes(bronze["classes"]),
        "stg_events": silver_events(bronze["events"]),
    }
    out = dict(silver)
    out.update(gold(silver["stg_cases"], silver["stg_districts"], silver["stg_classes"],
                    today=today))
    return out


SILVER = ("stg_cases", "stg_districts", "stg_classes", "stg_events")
GOLD = ("dim_district", "dim_class", "dim_calendar", "fact_cases")


def build_medallion(bronze: dict[str, DataFrame], base_dir: str, today=None,
                    fact_partition_by: tuple[str, ...] = (),
                    quarantine: bool = False) -> dict[str, DataFrame]:
    """Write silver, build gold *from the written silver*, write gold; return every
    table read back from its files.

    The tables of a layer are independent, so they are written as concurrent jobs;
    the files cut the lineage, so a lost
    executor never forces a recomputation from raw, and reports scan compact
    Parquet instead of re-deriving silver. ``fact_partition_by`` (e.g. a year
    column) lays the fact out for partition pruning at scale. ``quarantine`` also
    writes ``quarantine_cases``: the rows silver or gold leave out, with the reason.
    """
    from strata.sinks.writers import write_tables

    lazy = medallion(bronze, today)
    out = write_tables({name: lazy[name] for name in SILVER}, base_dir)
    built = gold(out["stg_cases"], out["stg_districts"], out["stg_classes"], today=today)

    def writer(df, path):
        w = df.write.mode("overwrite")
        if path.endswith("/fact_cases") and fact_partition_by:
            w = w.partitionBy(*fact_partition_by)
        w.parquet(path)

    out.update(write_tables({n: built[n] for n in ("dim_calendar", "fact_cases")}, base_dir,
                            writer=writer))
    if quarantine:
        out.update(write_tables({"quarantine_cases": quarantine_cases(bronze["cases"],
                                                                      out["stg_districts"])},
                                base_dir))
    # Conformed dimensions are the silver tables as they are (type-1).
    out["dim_district"] = out["stg_districts"]
    out["dim_class"] = out["stg_classes"]
    return out
