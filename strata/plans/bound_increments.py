"""Driver-facing queries: type inference, readers in splits, and tables kept up to date
from batches (stable ids, changed partitions, versions by date, report states, id sets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.asof import as_of_join
from strata.operators.batch_rules import rule_results
from strata.operators.bitmaps import daily_sets, distinct_between
from strata.operators.deltas import add_states, group_state, report, signed_changes
from strata.operators.extras import scd2_history
from strata.operators.keymap import load_key_map, with_key
from strata.operators.measures import duration_by
from strata.operators.shapes import frequent_shapes
from strata.operators.spellings import spelling_clusters
from strata.plans import tpch
from strata.session import scratch_dir
from strata.sinks.partitions import upsert_partitions
from strata.sinks.writers import write_bronze
from strata.sources import preview
from strata.sources.files import file_sizes
from strata.sources.infer import infer_types, merged, read_csv_inferred, state, types_of
from strata.sources.split_records import read_csv_records, read_json_array_records
from strata.sources.text_files import read_csv_text
from strata.streaming.versions import ingest_versions

# --- type inference ---------------------------------------------------------------------


def _customer_folder(spark: SparkSession, sf: str) -> str:
    from strata.plans.bound_queries import _customer_csv

    return _customer_csv(spark, sf)


def _orders_folder(spark: SparkSession, sf: str) -> str:
    """orders as CSV with values of every kind: day-first dates, stamps that are partly bare
    dates, flags, codes with leading zeros, numbers that are whole but for a few, blanks."""
    o = tpch.table(spark, sf, "orders")
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    path = scratch_dir(spark, "csv-src")
    o.select(
        k.alias("order_id"), F.col("o_totalprice").alias("price"), F.date_format(d, "yyyy-MM-dd").alias("ordered"),
        F.date_format(d, "dd/MM/yyyy").alias("day_first"), F.date_format(d, "M-d-yyyy").alias("month_first"),
        F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 12:30:"),
                                                                               F.lpad((k % 60).cast("string"), 2, "0"))).alias("stamp"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("FALSE")).alias("flag"), F.lpad(k.cast("string"), 12, "0").alias("code"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise(k.cast("string")).alias("mostly_whole"),
        F.when(k % 97 == 0, F.lit("n/d")).otherwise(k.cast("string")).alias("mostly_number"),
        F.lit(None).cast("string").alias("blank"),
    ).write.option("header", True).csv(path)
    return path


def csv_inferred_customer(spark: SparkSession, sf: str) -> DataFrame:
    """customer → CSV → typed by what its columns hold, nothing declared."""
    return read_csv_inferred(spark, _customer_folder(spark, sf))


def csv_inferred_orders(spark: SparkSession, sf: str) -> DataFrame:
    """orders with columns of every kind → CSV → typed by what they hold."""
    return read_csv_inferred(spark, _orders_folder(spark, sf))


def csv_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    """The types found, from states of two halves of each extract merged."""
    out = []
    for name, path in (("customer", _customer_folder(spark, sf)), ("orders", _orders_folder(spark, sf))):
        text = read_csv_text(spark, path, null_tokens=("",))
        half = F.pmod(F.xxhash64(text.columns[0]), F.lit(2))
        found = types_of(merged([state(text.filter(half == 0)), state(text.filter(half == 1))]))
        out.append(found.select(F.lit(name).alias("table_name"), "column_name", "type", "n_rows", "n_null"))
    return out[0].unionByName(out[1])


# --- readers in splits ----------------------------------------------------------------------


def csv_quoted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """customer with notes that hold line ends, quotes and commas, read in splits."""
    path = scratch_dir(spark, "csv-src")
    c = tpch.table(spark, sf, "customer")
    note = F.concat("c_name", F.lit('\nsays "'), "c_mktsegment", F.lit('",\n\n'), (F.col("c_custkey") % 7).cast("string"))
    c.select("c_custkey", note.alias("note"), "c_mktsegment").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    got = read_csv_records(spark, path, {"customer": "c_custkey", "note": "note", "segment": "c_mktsegment"})
    return infer_types(got, ["customer"])


def json_arrays_in_splits(spark: SparkSession, sf: str) -> DataFrame:
    """customer as JSON documents, each an array of a thousand objects, read in splits."""
    path = scratch_dir(spark, "json-src")
    c = tpch.table(spark, sf, "customer")
    record = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.concat("c_name", F.lit(' {"'), "c_mktsegment", F.lit('"}]')).alias("name"),
                                F.struct(F.array("c_nationkey", F.lit(1)).alias("xs")).alias("more")))
    block = F.floor(F.col("c_custkey") / 1000)
    docs = c.groupBy(block.alias("block")).agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(record)), ",\n"), F.lit("]\n")).alias("value"))
    docs.repartition("block").write.partitionBy("block").text(path)
    got = read_json_array_records(spark, path, {"customer": "key", "name": "name", "more": "more"})
    return infer_types(got, ["customer"])


# --- sources and sinks shown in full ------------------------------------------------------------


def preview_longest_cases(spark: SparkSession, sf: str) -> DataFrame:
    """A look at the ten longest cases, in a full order."""
    fact = tpch.model(spark, sf)["fact_cases"]
    return preview(fact.select("case_id", "district_id", "duration_days"), 10, [F.col("duration_days").desc_nulls_last(), F.col("case_id")])


STAMP = "2026-01-02T03:04:05.000006+00:00"


def bronze_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows with the instant of their ingestion, as every row carries it."""
    path = scratch_dir(spark, "bronze")
    raw = read_csv_text(spark, _customer_folder(spark, sf), ["c_custkey", "c_name"])
    rows = write_bronze(raw.select("c_custkey", "c_name"), path, STAMP)
    return spark.read.parquet(path).withColumn("n_written", F.lit(rows).cast("bigint"))


def file_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of text extracts, found by listing: each line's bytes and its line end."""
    places = {}
    for name, col in (("customer", "c_name"), ("part", "p_name")):
        path = f"{scratch_dir(spark, 'text-src')}/{name}"
        tpch.table(spark, sf, name).select(col).write.text(path)
        places[name] = ("text", path)
    return file_sizes(spark, places).select("dataset", "bytes", (F.col("n_files") > 0).alias("has_files"))


# --- tables kept up to date ---------------------------------------------------------------------


def stable_court_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Court ids over two loads: the second brings the districts that the first lacked, and
    the courts of the first keep their ids."""
    d = tpch.model(spark, sf)["stg_districts"].select("district_id")
    courts = d.select("district_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("court_number"))
    path, key = scratch_dir(spark, "court-ids"), ["district_id", "court_number"]
    load_key_map(courts.filter("district_id % 2 = 0"), path, key, "court_id")
    return with_key(courts, load_key_map(courts, path, key, "court_id"), key, "court_id")


def _older_and_updates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The fact as an older snapshot had it (late closings still open, some cases filed under
    another year), and the rows that changed since."""
    from strata.constants import STATUS_OPEN
    from strata.plans.bound_queries import UPSERT_CUTOFF

    fact = tpch.model(spark, sf)["fact_cases"]
    late = F.coalesce(F.col("closed") > F.lit(UPSERT_CUTOFF).cast("date"), F.lit(False))
    moved = F.col("case_id") % 50 == 7
    older = (fact.withColumn("duration_days", F.when(late | moved, F.lit(None)).otherwise(F.col("duration_days")).cast("bigint"))
                 .withColumn("status", F.when(late, F.lit(STATUS_OPEN)).otherwise(F.col("status")))
                 .withColumn("opened", F.when(moved, F.add_months("opened", 14)).otherwise(F.col("opened")))
                 .withColumn("closed", F.when(late, F.lit(None)).otherwise(F.col("closed")).cast("date")))
    return older.select(*fact.columns), fact.filter(late | moved)


def fact_changed_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The fact by year of opening, brought up to date by rewriting the touched years alone."""
    path = scratch_dir(spark, "fact-by-year")
    older, updates = _older_and_updates(spark, sf)
    year = F.year("opened").alias("open_year")
    older.select("*", F.lit(1).alias("version"), year).write.partitionBy("open_year").parquet(path)
    upsert_partitions(spark, path, updates.select("*", F.lit(2).alias("version"), year), "case_id", "version", "open_year")
    return spark.read.parquet(path).select("*").drop("version", "open_year").select(*older.columns)


VERSION_DATES = ("1992-01-01", "1995-03-01", "1998-06-01")


def duration_by_district_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Mean duration by the district name that was valid when the case was opened."""
    from strata.plans.bound_queries import _district_snapshots

    snaps = [s.withColumn("as_of", F.lit(day).cast("date")) for day, s in zip(VERSION_DATES, _district_snapshots(spark, sf))]
    history = scd2_history(snaps[0].unionByName(snaps[1]).unionByName(snaps[2]), "district_id", ["district_name", "uf"], "as_of")
    fact = tpch.model(spark, sf)["fact_cases"].select("case_id", "district_id", "opened", "duration_days")
    return duration_by(as_of_join(fact, history, "district_id", "opened", ["district_name"]), ["district_name"])


def report_from_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The report by district and year from a state and one batch's signed changes."""
    older, updates = _older_and_updates(spark, sf)
    groups = ["district_id", "cal_year"]
    year = F.year("opened").cast("bigint").alias("cal_year")
    path = scratch_dir(spark, "report-state")
    group_state(older.select("*", year), groups, "duration_days").write.parquet(path)
    changes = signed_changes(older, updates, "case_id").select("*", year)
    now = add_states(spark.read.parquet(path), group_state(changes, groups, "duration_days"))
    return report(now).join(tpch.model(spark, sf)["dim_district"].select("district_id", "district_name"), "district_id").drop("district_id")


RANGE = ("1994-03-15", "1996-09-20")


def distinct_any_range(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct districts and cases per court between two days, from sets stored by day."""
    fact = tpch.model(spark, sf)["fact_cases"]
    out = []
    for what, col in (("districts", "district_id"), ("cases", "case_id")):
        path = scratch_dir(spark, "id-sets")
        daily_sets(fact, ["court_id"], "opened", col).write.parquet(path)
        out.append(distinct_between(spark.read.parquet(path), ["court_id"], *[F.lit(d).cast("date") for d in RANGE], out=f"n_{what}"))
    return out[0].join(out[1], "court_id")


# --- rules, spellings and shapes ------------------------------------------------------------------


def dq_batch_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules on the cases opened from 1997 on, with planted copies of older ones and unknown
    districts, against the older cases: what the full rules say, without grouping the history."""
    fact = tpch.model(spark, sf)["fact_cases"].select("case_id", "district_id", "opened")
    late = F.col("opened") >= F.lit("1997-01-01").cast("date")
    history, fresh = fact.filter(~late), fact.filter(late)
    copies = history.filter("case_id % 211 = 5")
    lost = fresh.filter("case_id % 97 = 1").withColumn("case_id", -F.col("case_id")).withColumn("district_id", F.col("district_id") + 900)
    batch = fresh.unionByName(copies).unionByName(lost)
    return rule_results(history, batch, "case_id", tpch.model(spark, sf)["dim_district"], "district_id")


def misspelt_words(spark: SparkSession, sf: str) -> DataFrame:
    """First words of part names, some with a letter lost, doubled or swapped: clusters of
    spellings that belong together."""
    w, k = F.split("p_name", " ")[0], F.col("p_partkey") % 10
    rest = F.substr(w, F.lit(3))
    label = (F.when(k == 1, F.concat(F.left(w, F.lit(1)), rest)).when(k == 2, F.concat(w, F.right(w, F.lit(1))))
              .when(k == 3, F.concat(F.substr(w, F.lit(2), F.lit(1)), F.left(w, F.lit(1)), rest)).otherwise(w))
    return spelling_clusters(tpch.table(spark, sf, "part").select(label.alias("label")), "label")


def format_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Shapes that at least one in a hundred values of a raw case column has."""
    return frequent_shapes(tpch.bronze(spark, sf)["cases"])


def bronze_header_versions(spark: SparkSession, sf: str) -> DataFrame:
    """customer landed in two deliveries, the second with its columns in another order, one
    more and one less: one bronze with every record."""
    base = scratch_dir(spark, "versions")
    c = tpch.table(spark, sf, "customer")
    first, second = c.filter("c_custkey % 2 = 0"), c.filter("c_custkey % 2 = 1")
    places = (f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    first.select("c_custkey", "c_name", "c_nationkey").write.option("header", True).mode("append").csv(places[0])
    ingest_versions(spark, *places)
    second.select("c_mktsegment", "c_name", "c_custkey").write.option("header", True).mode("append").csv(places[0])
    bronze = ingest_versions(spark, *places)
    return infer_types(bronze.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ["c_custkey", "c_nationkey"])


QUERIES = {f.__name__: f for f in (
    csv_inferred_customer, csv_inferred_orders, csv_inferred_types, csv_quoted_lines, json_arrays_in_splits, preview_longest_cases,
    bronze_stamp, file_bytes, stable_court_ids, fact_changed_partitions, duration_by_district_as_of, report_from_deltas,
    distinct_any_range, dq_batch_rules, misspelt_words, format_shapes, bronze_header_versions)}
