"""Binding of the case-duration model to the TPC-H-style test tables.

The model's roles are played by:

* case                → ``orders`` (id ``o_orderkey``, open date ``o_orderdate``)
* district            → ``nation`` reached through ``customer.c_nationkey``
* class               → the digit of ``o_orderpriority``
* court (per district)→ ``customer.c_mktsegment`` numbered 1..5
* closing event       → ``lineitem`` rows with ``l_returnflag = 'A'``; the first wins
* case events         → every ``lineitem`` row (fan-out grain)

The raw ("bronze") tables are text, derived deterministically from those tables
with the defects the cleaning layer must handle: ids written ``123.0``, missing
ids, mixed date formats (ISO, ``yyyy/MM/dd``, ``dd/MM/yyyy``, ``d/M/yyyy``, clock
suffix), unparseable dates, whole-row duplicates in another format, an unknown
district, names with stray case and blanks, one class written three ways.
The same derivation in DuckDB SQL lives in ``strata.plans.tpch_sql``.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import INGESTED_AT, STATUS_CLOSED, STATUS_OPEN
from strata.operators.calendar import calendar
from strata.operators.events import first_event
from strata.operators.star import build_fact
from strata.plans import medallion as M
from strata.plans.normalise import LayeredModel, normalise
from strata.session import layers_dir, session_id
from strata.sinks.writers import batch_timestamp, write_bronze

# --- fixed values ---------------------------------------------------------
# Market segments, in the order that numbers the courts 1..5.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# Event labels per l_returnflag.
RETURNFLAG_EVENT = (("A", "Baixa Definitiva"), ("R", "Sentença"))
OTHER_EVENT = "Despacho"


_BUILT: dict[tuple, object] = {}
_LOCKS: dict[tuple, threading.RLock] = {}  # one build per key even when queries run from several threads
_GUARD = threading.Lock()


def _built(key: tuple, build):
    """What ``build`` makes, once per key; other keys are built meanwhile."""
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.RLock())
    with lock:
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    # per session object: cached frames (and views made from them) belong to it
    return (session_id(spark), id(spark), os.path.abspath(sf_dir), what)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fmt_date(d: Column, sel: Column) -> Column:
    """Render a date in one of five text formats chosen by ``sel`` (0..4)."""
    return (F.when(sel == 0, F.date_format(d, "dd/MM/yyyy"))
             .when(sel == 1, F.date_format(d, "yyyy/MM/dd"))
             .when(sel == 2, F.date_format(d, "d/M/yyyy"))
             .when(sel == 3, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00")))
             .otherwise(F.date_format(d, "yyyy-MM-dd")))


def close_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First closing event (return flag ``A``) per order: ``(case_id, closed)``."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("case_id"), "l_returnflag",
        F.to_date("l_shipdate").alias("ship"))
    return first_event(li, "case_id", "ship", "l_returnflag", "A", "closed")


def bronze_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    raw = (o.join(c, o.o_custkey == c.c_custkey)
            .join(close_events(spark, sf_dir), o.o_orderkey == F.col("case_id"), "left")
            .select(F.col("o_orderkey").alias("k"), F.col("c_nationkey").alias("d"),
                    F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]),
                                     F.col("c_mktsegment")).alias("v"),
                    F.to_date("o_orderdate").alias("od"), F.col("closed").alias("cd"),
                    F.col("o_orderpriority").alias("pr")))
    k = F.col("k")
    copies = raw.withColumn("cp", F.explode(F.when(k % 9 == 0, F.array(F.lit(0), F.lit(1)))
                                             .otherwise(F.array(F.lit(0)))))
    cp = F.col("cp")
    ks = k.cast("string")
    return copies.select(
        F.when(k % 101 == 0, F.lit(None).cast("string"))
         .when((k + cp) % 10 == 3, F.concat(ks, F.lit(".0")))
         .otherwise(ks).alias("case_id"),
        F.substring("pr", 1, 1).alias("class_id"),
        F.when(k % 89 == 0, F.lit("99")).otherwise(F.col("d").cast("string")).alias("district_id"),
        F.col("v").cast("string").alias("court_id"),
        F.when(k % 211 == 0, F.lit("n/d"))
         .otherwise(fmt_date(F.col("od"), (k + cp) % 5)).alias("opened"),
        F.when(F.col("cd").isNotNull(), fmt_date(F.col("cd"), (k + cp + 2) % 5)).alias("closed"),
        F.when(F.col("cd").isNull(), F.lit(STATUS_OPEN)).otherwise(F.lit(STATUS_CLOSED))
         .alias("status"),
    )


def bronze_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("n_nationkey")
    name = F.regexp_replace("n_name", "_", " ")
    return j.select(
        key.cast("string").alias("district_id"),
        F.when(key % 4 == 0, F.lower(name))
         .when(key % 4 == 1, F.concat(F.lit("  "), name))
         .when(key % 4 == 2, F.concat(name, F.lit(" ")))
         .otherwise(F.upper(name)).alias("district_name"),
        F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lower("r_name"), F.lit(" ")))
         .otherwise(F.col("r_name")).alias("uf"),
    )


def bronze_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    x = F.expr("substring(o_orderpriority, 3)")
    k = F.col("o_orderkey")
    return o.select(
        F.substring("o_orderpriority", 1, 1).alias("class_id"),
        F.when(k % 3 == 0, F.upper(x))
         .when(k % 3 == 1, F.lower(x))
         .otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x)))))
         .alias("class_name"))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                 "l_shipdate")
    k = F.col("l_orderkey")
    s = k + F.col("l_linenumber")
    label = F.when(F.col("l_returnflag") == RETURNFLAG_EVENT[0][0], F.lit(RETURNFLAG_EVENT[0][1]))
    for flag, text in RETURNFLAG_EVENT[1:]:
        label = label.when(F.col("l_returnflag") == flag, F.lit(text))
    return li.select(
        F.when(s % 151 == 0, F.lit(None).cast("string"))
         .when(s % 13 == 0, F.concat(k.cast("string"), F.lit(".0")))
         .otherwise(k.cast("string")).alias("case_id"),
        label.otherwise(F.lit(OTHER_EVENT)).alias("event_type"),
        fmt_date(F.to_date("l_shipdate"), s % 5).alias("event_date"),
    )


RAW = {"cases": bronze_cases, "districts": bronze_districts, "classes": bronze_classes, "events": bronze_events}


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw text tables (lazy derivations from the test tables)."""
    return {name: fn(spark, sf_dir) for name, fn in RAW.items()}


class Layer(Mapping):
    """Tables of a layer, each written on first use (once per session) and read back."""

    def __init__(self, spark: SparkSession, sf_dir: str, what: str, builders: dict):
        self._spark, self._sf, self._what, self._builders = spark, sf_dir, what, builders

    def __getitem__(self, name: str) -> DataFrame:
        build = self._builders[name]
        if isinstance(build, str):  # the same table under another name
            return self[build]
        key = (*_key(self._spark, self._sf, self._what), name)
        return _built(key, lambda: build(f"{_folder(self._spark, self._sf, self._what)}/{name}"))

    def build_all(self, names=None, parallel: int = 4) -> None:
        """Write the named tables (all of them) as concurrent jobs; a table that another one
        needs is built once, by whoever comes first."""
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(self.__getitem__, names or self))

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def _store(spark: SparkSession, make):
    """A builder of ``Layer``: writes what ``make`` gives and reads it back."""
    def build(path):
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return build


def _folder(spark: SparkSession, sf_dir: str, what: str) -> str:
    return _built((*_key(spark, sf_dir, what), "folder"), lambda: layers_dir(spark, what))


def bronze(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Mapping[str, DataFrame]:
    """The bronze layer: each raw text table is landed on first use as stamped Parquet
    (the stamp column is dropped on read, as silver never uses it). Silver and the
    normaliser both read these files, so the joins that derive the raw cases run once."""
    if not materialize:
        return raw_extracts(spark, sf_dir)

    def land(name):
        def build(path):
            write_bronze(RAW[name](spark, sf_dir), path, batch_timestamp())
            return spark.read.parquet(path).drop(INGESTED_AT)
        return build

    return Layer(spark, sf_dir, "bronze", {name: land(name) for name in RAW})


def model(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Mapping[str, DataFrame]:
    """Silver and gold tables of the bound model.

    ``materialize`` (default) writes each table and its inputs on first use, once per
    session: silver from the landed bronze, gold from the written silver; every report
    reads those files. ``materialize=False`` returns the lazy end-to-end plans.
    """
    if not materialize:
        return M.medallion(raw_extracts(spark, sf_dir))
    raw, store = bronze(spark, sf_dir), partial(_store, spark)
    c = M.CaseCols()
    layer = Layer(spark, sf_dir, "medallion", {
        "stg_cases": store(lambda: M.silver_cases(raw["cases"])),
        "stg_districts": store(lambda: M.silver_districts(raw["districts"])),
        "stg_classes": store(lambda: M.silver_classes(raw["classes"])),
        "stg_events": store(lambda: M.silver_events(raw["events"])),
        "dim_district": "stg_districts", "dim_class": "stg_classes",
        "dim_calendar": store(lambda: calendar(layer["stg_cases"], c.opened, c.closed)),
        "fact_cases": store(lambda: build_fact(layer["stg_cases"], layer["stg_districts"], c.district_id,
                                               c.opened, c.closed))})
    return layer


def normalised(spark: SparkSession, sf_dir: str, materialize: bool = True):
    """The event-sourced model of the bound cases (by default each table is written once per
    session, on first use)."""
    if not materialize:
        b = raw_extracts(spark, sf_dir)
        return normalise(b["cases"], b["districts"], b["classes"])

    def layer(tables):
        return Layer(spark, sf_dir, "normalised", {name: _store(spark, make) for name, make in tables.items()})

    return _built(_key(spark, sf_dir, "normalised"), lambda: LayeredModel(spark, bronze(spark, sf_dir), layer))


def clean_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with stray case and blanks, title-cased."""
    from strata.functions import title_case
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    dirty = (F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
              .when(k % 3 == 1, F.upper("p_name")).otherwise(F.col("p_name")))
    return p.select(k.alias("part_id"), title_case(dirty).alias("part_name"))

