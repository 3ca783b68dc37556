"""Driver-facing queries: every operator of the model run on the test tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame (a few build
scratch files first: the round-trips and the dense-id checkpoints).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import case_number, safe_int
from strata.operators import profile as P
from strata.operators import quality as Q
from strata.operators.events import lifecycle_events
from strata.operators.keys import dense_ids
from strata.plans import reports as R
from strata.plans import tpch
from strata.plans.ingest import ingest_file
from strata.plans.lakehouse import default_rules
from strata.plans.medallion import parse_mixed_date
from strata.session import scratch_dir
from strata.sources import SourceCatalog, file_sizes, parquet_path_sql

# --- gold reports -----------------------------------------------------------


def duration_by_district_class_year(spark: SparkSession, sf: str) -> DataFrame:
    return R.by_district_class_year(tpch.model(spark, sf))


def duration_by_district_year(spark: SparkSession, sf: str) -> DataFrame:
    return R.by_district_year(tpch.model(spark, sf))


def duration_by_court_min_support(spark: SparkSession, sf: str) -> DataFrame:
    return R.by_court(tpch.model(spark, sf), min_support=3)


def court_key_not_unique(spark: SparkSession, sf: str) -> DataFrame:
    return R.court_key_not_unique(tpch.model(spark, sf))


def grain_mean(spark: SparkSession, sf: str) -> DataFrame:
    return R.grain(tpch.model(spark, sf))


def fanout_mean(spark: SparkSession, sf: str) -> DataFrame:
    m = tpch.model(spark, sf)
    return R.fanout(m, m["stg_events"])


def grain_report(spark: SparkSession, sf: str) -> DataFrame:
    m = tpch.model(spark, sf)
    return R.grain_vs_fanout(m, m["stg_events"])


def close_role_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return R.close_role_by_year(tpch.model(spark, sf))


# --- gold and silver tables ------------------------------------------------------


def calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["dim_calendar"]


def fact_cases(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["fact_cases"]


def clean_cases(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["stg_cases"]


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.clean_part_names(spark, sf)


def clean_districts(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["stg_districts"]


def preferred_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["stg_classes"]


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["stg_events"]


def dim_district(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["dim_district"]


def dim_class(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.model(spark, sf)["dim_class"]


def case_number_q(spark: SparkSession, sf: str) -> DataFrame:
    s = tpch.model(spark, sf)["stg_cases"]
    return s.select("case_id", "district_id",
                    case_number("case_id", "district_id").alias("case_number"))


# --- normalised (event-sourced) model -------------------------------------------------


def norm_courts(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.normalised(spark, sf).vara


def norm_classes(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.normalised(spark, sf).classe


def norm_districts(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.normalised(spark, sf).comarca


def norm_cases(spark: SparkSession, sf: str) -> DataFrame:
    n = tpch.normalised(spark, sf)
    return n.processo.join(F.broadcast(n.situacao.withColumnRenamed("description", "status")),
                           "status_id")


def norm_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events numbered from 1 in the order of case, type and date."""
    events = tpch.normalised(spark, sf).movimentacao.drop("event_id")
    return dense_ids(events, ["case_id", "event_type_id", "event_date"], "event_id").select(
        "event_id", "case_id", "event_type_id", "event_date")


def norm_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.normalised(spark, sf).counts


def event_union(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle_events(tpch.normalised(spark, sf).proc_raw, "case_id", "opened", "closed")


def first_close_event(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_closure(tpch.normalised(spark, sf))


def duration_from_events(spark: SparkSession, sf: str) -> DataFrame:
    return R.duration_from_events(tpch.normalised(spark, sf), min_support=3)


def events_equal_gold(spark: SparkSession, sf: str) -> DataFrame:
    return R.events_equal_gold(tpch.model(spark, sf), tpch.normalised(spark, sf), 3)


# --- data quality --------------------------------------------------------------------------

RULES = default_rules()


def _suite(spark, sf, kinds=None):
    rules = [r for r in RULES if kinds is None or r.kind in kinds]
    return Q.run_suite(tpch.model(spark, sf), rules)


def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    return _suite(spark, sf)


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _suite(spark, sf, {"not_null"})


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _suite(spark, sf, {"unique"})


def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return _suite(spark, sf, {"accepted_values"})


def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    return _suite(spark, sf, {"relationships"})


# --- profiling ------------------------------------------------------------------------------


def profile_mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    return P.mixed_formats(tpch.bronze(spark, sf)["cases"], "opened")


def profile_slash_dates(spark: SparkSession, sf: str) -> DataFrame:
    return P.values_with(tpch.bronze(spark, sf)["cases"], "closed", "/")


def profile_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return P.duplicate_keys(tpch.bronze(spark, sf)["cases"], "case_id")


def profile_missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    return P.missing_ids(tpch.bronze(spark, sf)["cases"], "case_id")


def profile_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return P.orphans(tpch.bronze(spark, sf)["cases"], tpch.bronze(spark, sf)["districts"],
                     "district_id", select=["case_id", "district_id"])


def profile_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return P.spelling_variants(tpch.bronze(spark, sf)["classes"], "class_id", "class_name",
                               key_name="class_id")


def profile_summary(spark: SparkSession, sf: str) -> DataFrame:
    b = tpch.bronze(spark, sf)
    return P.profile_summary(b["cases"], b["districts"], b["classes"])


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    m = tpch.model(spark, sf)
    return P.schema_drift(tpch.bronze(spark, sf)["cases"], m["stg_cases"])


# --- sources and sinks -------------------------------------------------------------------


def parquet_path_scan(spark: SparkSession, sf: str) -> DataFrame:
    return parquet_path_sql(
        spark, f"{sf.rstrip('/')}/orders.parquet",
        "select o_orderstatus, count(*) as n_orders, "
        "cast(min(o_orderdate) as date) as first_order, "
        "cast(max(o_orderdate) as date) as last_order from {src} group by o_orderstatus")


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def _customer_csv(spark, sf) -> str:
    src = scratch_dir(spark, "csv-src") + "/customer_csv"
    (tpch.table(spark, sf, "customer").select(*CUSTOMER_COLS)
        .write.mode("overwrite").option("header", True).csv(src))
    return src


def _typed_customer(bronze: DataFrame, *more) -> DataFrame:
    return bronze.select(safe_int("c_custkey", "bigint").alias("c_custkey"), "c_name",
                         safe_int("c_nationkey", "int").alias("c_nationkey"),
                         F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
                         "c_mktsegment", *more)


def bronze_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """customer → CSV extract → text bronze (stamped Parquet) → typed again."""
    src = _customer_csv(spark, sf)
    out = ingest_file(spark, "csv", src, scratch_dir(spark, "bronze") + "/customer",
                      columns=CUSTOMER_COLS)
    return _typed_customer(out.bronze)


def bronze_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """orders → JSON-lines extract → text bronze → typed again."""
    src = scratch_dir(spark, "json-src")
    (tpch.table(spark, sf, "orders").select(*ORDER_COLS)
        .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .write.mode("overwrite").json(src))
    out = ingest_file(spark, "json", src, scratch_dir(spark, "bronze") + "/orders",
                      columns=ORDER_COLS, json_array=False)
    b = out.bronze
    return b.select(safe_int("o_orderkey", "bigint").alias("o_orderkey"),
                    safe_int("o_custkey", "bigint").alias("o_custkey"), "o_orderstatus",
                    F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
                    parse_mixed_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def bronze_stream_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """customer → CSV landing folder → incremental (streaming) bronze → typed again."""
    from strata.streaming import ingest_available

    src = _customer_csv(spark, sf)
    base = scratch_dir(spark, "stream")
    bronze = ingest_available(spark, "csv", src, CUSTOMER_COLS, f"{base}/bronze",
                              f"{base}/checkpoint")
    return _typed_customer(bronze)


def bronze_csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """customer under other header names, in another order, with a further column."""
    src = scratch_dir(spark, "csv-src")
    c = tpch.table(spark, sf, "customer")
    (c.select(F.col("c_mktsegment").alias("Segment"), F.lit("x").alias("Extra"), F.col("c_acctbal").alias("Balance"),
              F.col("c_custkey").alias("Number"), F.col("c_nationkey").alias("Nation"), F.col("c_name").alias("Full name"))
      .write.option("header", True).csv(f"{src}/in"))
    names = {"c_custkey": "Number", "c_name": "Full name", "c_nationkey": "Nation", "c_acctbal": "Balance",
             "c_mktsegment": "Segment"}
    out = ingest_file(spark, "csv", f"{src}/in", f"{src}/bronze", columns=names)
    return _typed_customer(out.bronze, F.col("Extra").alias("extra"))


def bronze_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Extracts with surplus fields and broken JSON: every record is accounted for, read
    or put aside with its text."""
    from strata.sources.text_files import CORRUPT, read_csv_text, read_json_text

    base = scratch_dir(spark, "bad-src")
    c = tpch.table(spark, sf, "customer")
    k = F.col("c_custkey")
    line = F.concat_ws(",", k, F.when(k % 7 == 0, F.lit('"a, ""b"""')).otherwise(F.lit("a")), "c_nationkey")
    line = F.when(k % 10 == 3, F.concat(line, F.lit(",surplus"))).when(k % 10 == 4, k.cast("string")).otherwise(line)
    # the first row of every task, so of every file, comes with the header in front
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    head = F.array(F.lit("id,label,nation"), "value")
    lines = c.select(line.alias("value"), place.alias("place"))
    (lines.select(F.explode(F.when(F.col("place") == 0, head).otherwise(F.array("value"))).alias("value"))
          .write.text(f"{base}/csv"))
    doc = F.concat(F.lit('{"id": '), k, F.lit(', "nation": '), "c_nationkey", F.lit("}"))
    doc = (F.when(k % 10 == 5, F.concat(F.lit("{broken "), k)).when(k % 10 == 6, F.concat(F.lit('{"other": '), k, F.lit("}")))
            .otherwise(doc))
    c.select(doc.alias("value")).write.text(f"{base}/json")
    csv = read_csv_text(spark, f"{base}/csv", ["id", "label", "nation"], multiline=False, on_malformed="quarantine")
    js = read_json_text(spark, f"{base}/json", ["id", "nation"], array=False, on_malformed="quarantine")
    parts = [df.groupBy(F.lit(name).alias("source"), F.col(CORRUPT).isNotNull().alias("malformed"))
               .agg(F.count(F.lit(1)).alias("n_records"), F.count("nation").alias("n_nations"))
             for name, df in (("csv", csv), ("json", js))]
    return parts[0].unionByName(parts[1])


def bronze_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """nation as one JSON document per region, each an array of objects."""
    base = scratch_dir(spark, "json-src")
    n = tpch.table(spark, sf, "nation")
    record = F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key")))
    (n.groupBy("n_regionkey").agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(record)), ",\n"),
                                           F.lit("]")).alias("value"))
      .repartition(8, "n_regionkey").select("value", "n_regionkey").write.partitionBy("n_regionkey").text(f"{base}/in"))
    out = ingest_file(spark, "json", f"{base}/in", f"{base}/bronze", columns={"n_nationkey": "key", "n_name": "name"})
    return out.bronze.select(safe_int("n_nationkey", "int").alias("n_nationkey"), "n_name")


def lenient_ints(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys in awkward spellings read back: long fractions, padded and overlong hex
    and binary."""
    k = F.col("o_orderkey")
    text = (F.when(k % 6 == 0, F.concat(k.cast("string"), F.lit(".49999999999999")))
             .when(k % 6 == 1, F.concat(F.lit("0x"), F.repeat(F.lit("0"), 70), F.hex(k)))
             .when(k % 6 == 2, F.concat(F.lit("0b"), F.repeat(F.lit("0"), 300), F.bin(k)))
             .when(k % 6 == 3, F.concat(F.lit("0x1"), F.repeat(F.lit("0"), 16), F.hex(k)))
             .when(k % 6 == 4, F.concat(k.cast("string"), F.lit(".5")))
             .otherwise(F.concat(k.cast("string"), F.lit("e0"))))
    return tpch.table(spark, sf, "orders").select(k.alias("o_orderkey"), safe_int(text, "bigint").alias("value"))


def incremental_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed snapshots of all cases, districts and classes: the older one with cases
    still open and other spellings. The fact is that of the newer one alone."""
    from strata.plans.lakehouse import land_incremental, newest_per_key, KEYS
    from strata.plans.medallion import medallion
    from strata.streaming.bronze_stream import EXTRACT

    base = scratch_dir(spark, "landing")
    raw = tpch.bronze(spark, sf)
    older = {"cases": raw["cases"].withColumn("closed", F.lit(None).cast("string")).withColumn("status", F.lit("Em andamento")),
             "districts": raw["districts"].withColumn("district_name", F.lit("old name")),
             "classes": raw["classes"].withColumn("class_name", F.lit("Aold"))}
    sources = {role: ("json", f"{base}/{role}") for role in older}
    for name, batch in (("extract-1", older), ("extract-2", {role: raw[role] for role in older})):
        for role, df in batch.items():
            df.write.option("ignoreNullFields", False).json(f"{base}/{role}/{name}")
        landed = land_incremental(spark, sources, f"{base}/lake", json_array=False, extract_folders=True)
    frames = {role: newest_per_key(df, KEYS[role]).drop(EXTRACT) for role, df in landed.items()}
    lake = medallion(frames)
    return (lake["fact_cases"].join(lake["dim_district"], "district_id").join(lake["dim_class"], "class_id", "left")
                .select(*lake["fact_cases"].columns, "district_name", "class_name"))


def named_source(spark: SparkSession, sf: str) -> DataFrame:
    """A declared source read through its path template."""
    return SourceCatalog(sf.rstrip("/") + "/{name}.parquet").read(spark, "region").select("r_regionkey", "r_name")


def calendar_all_open(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar when no case is closed: it ends today (here a fixed day)."""
    from strata.operators.calendar import calendar

    cases = tpch.model(spark, sf)["stg_cases"].withColumn("closed", F.lit(None).cast("date"))
    return calendar(cases, "opened", "closed", today="2003-07-01")


def ingest_checks(spark: SparkSession, sf: str) -> DataFrame:
    src = _customer_csv(spark, sf)
    out = ingest_file(spark, "csv", src, scratch_dir(spark, "bronze") + "/customer",
                      columns=CUSTOMER_COLS)
    return Q.ingestion_checks(out.source, out.bronze, CUSTOMER_COLS, records=out.records)


def file_sizes_q(spark: SparkSession, sf: str) -> DataFrame:
    """The audit's machine-independent part: which forms of a table exist and hold bytes."""
    src = _customer_csv(spark, sf)
    sizes = file_sizes(spark, {"customer_csv": ("csv", src),
                               "customer_parquet": ("parquet", f"{sf.rstrip('/')}/customer.parquet")})
    return sizes.select("dataset", "format", (F.col("n_files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


# --- SQL serving ------------------------------------------------------------------------


def flagship_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship report written in SQL over the gold tables served as views."""
    from strata.plans.sql_reports import run_report, serve_views

    serve_views(tpch.model(spark, sf), prefix="gold_")
    return run_report(spark, "by_district_class_year", prefix="gold_")


def _sql_report(name):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        from strata.plans.sql_reports import run_report, serve_views

        serve_views(tpch.model(spark, sf), prefix="gold_")
        return run_report(spark, name, prefix="gold_", min_support=3)

    query.__name__, query.__doc__ = f"{name}_sql", f"The report {name} in SQL over the served views."
    return query


by_court_sql = _sql_report("by_court")
by_district_year_sql = _sql_report("by_district_year")
court_key_not_unique_sql = _sql_report("court_key_not_unique")
grain_mean_sql = _sql_report("grain_mean")
fanout_mean_sql = _sql_report("fanout_mean")


def duration_from_events_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The by-court question in SQL over the event-sourced tables served as views."""
    from strata.plans.sql_reports import run_event_model_report, serve_normalised_views

    serve_normalised_views(tpch.normalised(spark, sf), prefix="oltp_")
    return run_event_model_report(spark, prefix="oltp_", min_support=3)


# --- optional tier: improvements described by the model, not applied by it -------------

AS_OF = "2002-01-01"          # date open cases are aged to
UPSERT_CUTOFF = "2000-01-01"  # snapshot date of the older fact in the upsert check


def quarantine_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Rows silver would drop, kept with the reason instead of vanishing."""
    from strata.plans.medallion import quarantine_cases as quarantined

    return quarantined(tpch.bronze(spark, sf)["cases"], tpch.model(spark, sf)["stg_districts"])


def duration_by_district_with_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan cases reported under the unknown district instead of being dropped."""
    from strata.functions import duration_days
    from strata.operators.extras import remap_orphans, with_unknown_member
    from strata.operators.star import Dim, star_join

    m = tpch.model(spark, sf)
    dim = with_unknown_member(m["stg_districts"], "district_id", "district_name")
    cases = remap_orphans(m["stg_cases"], m["stg_districts"], "district_id").withColumn(
        "duration_days", duration_days("opened", "closed"))
    from strata.operators.measures import duration_by
    return duration_by(star_join(cases, [Dim(dim, "district_id")]), ["district_name"])


def bronze_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Source and row hash (over every text column) stamped at ingestion. The source is
    shown as the folder of the extract; part names differ by run."""
    from strata.operators.extras import with_lineage
    from strata.sources.text_files import text_schema

    raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
                .schema(text_schema(CUSTOMER_COLS)).csv(_customer_csv(spark, sf)))
    lined = with_lineage(raw, CUSTOMER_COLS)
    return lined.select("c_custkey", "_row_hash",
                        F.substring_index(F.substring_index("_source_file", "/", -2), "/", 1).alias("_source"))


def open_case_age(spark: SparkSession, sf: str) -> DataFrame:
    """Open cases aged to a fixed date, by district."""
    from strata.operators.extras import aged_duration_days

    m = tpch.model(spark, sf)
    open_cases = (m["fact_cases"].filter(F.col("closed").isNull())
                  .withColumn("age_days", aged_duration_days("opened", "closed", AS_OF)))
    return (open_cases.join(m["dim_district"], "district_id")
            .groupBy("district_name")
            .agg(F.count(F.lit(1)).alias("n_open"),
                 F.round(F.avg("age_days"), 1).alias("avg_age_days")))


def fact_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """An older snapshot of the fact (cases closed after the cutoff still open) plus
    the closings since, upserted: equals the current fact."""
    from strata.operators.extras import upsert_snapshot

    fact = tpch.model(spark, sf)["fact_cases"]
    late = F.col("closed") > F.lit(UPSERT_CUTOFF).cast("date")
    older = fact.select(
        *[F.when(late, F.lit(None).cast(fact.schema[c].dataType)).otherwise(F.col(c)).alias(c)
          if c in ("closed", "duration_days") else
          (F.when(late, F.lit("Em andamento")).otherwise(F.col(c)).alias(c) if c == "status"
           else F.col(c)) for c in fact.columns],
        F.lit(UPSERT_CUTOFF).cast("date").alias("snapshot_date"))
    updates = fact.filter(late).withColumn("snapshot_date", F.col("closed"))
    return upsert_snapshot(older, updates, "case_id", "snapshot_date").drop("snapshot_date")


def drill_across_district(spark: SparkSession, sf: str) -> DataFrame:
    """Closed-case durations and event volumes side by side per district."""
    from strata.operators.extras import drill_across

    m = tpch.model(spark, sf)
    fact = m["fact_cases"]
    durations = (fact.filter(F.col("duration_days").isNotNull()).groupBy("district_id")
                 .agg(F.count(F.lit(1)).alias("n_closed"),
                      F.round(F.avg("duration_days"), 1).alias("avg_days")))
    per_case = m["stg_events"].groupBy("case_id").agg(F.count(F.lit(1)).alias("_n"))
    volumes = (per_case.join(fact.select("case_id", "district_id"), "case_id")
               .groupBy("district_id").agg(F.sum("_n").alias("n_events")))
    return drill_across(durations, volumes, ["district_id"])


SNAPSHOT_DATES = ("2024-01-01", "2024-02-01", "2024-03-01")


def district_history(spark: SparkSession, sf: str) -> DataFrame:
    """Type-2 history of the district dimension over three dated snapshots (the
    later ones re-spell some names)."""
    from strata.operators.extras import scd2_history

    snaps = [snap.withColumn("as_of", F.lit(as_of).cast("date"))
             for as_of, snap in zip(SNAPSHOT_DATES, _district_snapshots(spark, sf))]
    allsnaps = snaps[0].unionByName(snaps[1]).unionByName(snaps[2])
    return scd2_history(allsnaps, "district_id", ["district_name", "uf"], "as_of")


def _district_snapshots(spark: SparkSession, sf: str) -> list[DataFrame]:
    d = tpch.model(spark, sf)["stg_districts"]
    k = F.col("district_id")
    return [
        d,
        d.withColumn("district_name", F.when(k % 3 == 0, F.upper("district_name"))
                     .otherwise(F.col("district_name"))),
        d.withColumn("district_name", F.when(k % 5 == 0, F.lower("district_name"))
                     .otherwise(F.col("district_name"))),
    ]


def district_history_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same type-2 history built incrementally: each snapshot merged into the
    history so far (one join on the key per snapshot)."""
    from strata.operators.extras import scd2_merge

    hist = None
    for as_of, snap in zip(SNAPSHOT_DATES, _district_snapshots(spark, sf)):
        hist = scd2_merge(hist, snap, "district_id", ["district_name", "uf"], as_of)
    return hist


QUERIES = {
    "duration_by_district_class_year": duration_by_district_class_year,
    "duration_by_district_year": duration_by_district_year,
    "duration_by_court_min_support": duration_by_court_min_support,
    "court_key_not_unique": court_key_not_unique,
    "grain_mean": grain_mean,
    "fanout_mean": fanout_mean,
    "grain_report": grain_report,
    "close_role_by_year": close_role_by_year,
    "calendar_dim": calendar_dim,
    "fact_cases": fact_cases,
    "clean_cases": clean_cases,
    "clean_names": clean_names,
    "clean_districts": clean_districts,
    "preferred_spelling": preferred_spelling,
    "clean_events": clean_events,
    "dim_district": dim_district,
    "dim_class": dim_class,
    "case_number": case_number_q,
    "norm_courts": norm_courts,
    "norm_classes": norm_classes,
    "norm_districts": norm_districts,
    "norm_cases": norm_cases,
    "norm_events": norm_events,
    "norm_counts": norm_counts,
    "event_union": event_union,
    "first_close_event": first_close_event,
    "duration_from_events": duration_from_events,
    "events_equal_gold": events_equal_gold,
    "dq_suite": dq_suite,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "profile_mixed_dates": profile_mixed_dates,
    "profile_slash_dates": profile_slash_dates,
    "profile_duplicates": profile_duplicates,
    "profile_missing_ids": profile_missing_ids,
    "profile_orphans": profile_orphans,
    "profile_spellings": profile_spellings,
    "profile_summary": profile_summary,
    "schema_drift": schema_drift,
    "parquet_path_scan": parquet_path_scan,
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_json_roundtrip": bronze_json_roundtrip,
    "bronze_stream_roundtrip": bronze_stream_roundtrip,
    "ingest_checks": ingest_checks,
    "file_sizes": file_sizes_q,
    "bronze_csv_by_name": bronze_csv_by_name,
    "bronze_malformed": bronze_malformed,
    "bronze_json_array": bronze_json_array,
    "lenient_ints": lenient_ints,
    "incremental_two_batches": incremental_two_batches,
    "named_source": named_source,
    "calendar_all_open": calendar_all_open,
    "by_district_year_sql": by_district_year_sql,
    "court_key_not_unique_sql": court_key_not_unique_sql,
    "grain_mean_sql": grain_mean_sql,
    "fanout_mean_sql": fanout_mean_sql,
    "flagship_sql": flagship_sql,
    "by_court_sql": by_court_sql,
    "duration_from_events_sql": duration_from_events_sql,
    "quarantine_cases": quarantine_cases,
    "duration_by_district_with_unknown": duration_by_district_with_unknown,
    "bronze_lineage": bronze_lineage,
    "open_case_age": open_case_age,
    "fact_upsert": fact_upsert,
    "drill_across_district": drill_across_district,
    "district_history": district_history,
    "district_history_merged": district_history_merged,
}

from strata.plans.bound_increments import QUERIES as _INCREMENTS  # noqa: E402

QUERIES.update(_INCREMENTS)
