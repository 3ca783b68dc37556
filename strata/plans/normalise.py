"""Snapshot → event-sourced (normalised) model.

From raw cases that carry their close date, build seven relational tables in
which closing is an *event*: districts, courts, classes, two code tables, cases
(no close date) and case events.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import COURTS_PER_DISTRICT, EVENT_TYPE_CODES, STATUS_CODES
from strata.functions import case_number, court_label, strict_int
from strata.operators.counts import table_counts
from strata.operators.dedup import keep_any
from strata.operators.events import lifecycle_events
from strata.operators.keys import dense_ids
from strata.operators.star import semi_join
from strata.plans.medallion import CaseCols, ClassCols, DistrictCols, silver_districts, type_cases


def code_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The two literal code tables (bounded: a handful of rows each)."""
    return {
        "situacao": spark.createDataFrame(list(STATUS_CODES), "status_id int, description string"),
        "tipo_movimento": spark.createDataFrame(list(EVENT_TYPE_CODES),
                                                "event_type_id int, description string"),
    }


def courts(districts: DataFrame, per_district: int = COURTS_PER_DISTRICT) -> DataFrame:
    """``per_district`` numbered courts in every district, with a dense global id
    ordered by (district, number) and a label. The expansion is an ``explode`` of
    a generated sequence — no join."""
    numbered = districts.select("district_id",
                                F.explode(F.sequence(F.lit(1), F.lit(per_district))).alias("court_no"))
    return (dense_ids(numbered, ["district_id", "court_no"], "court_id")
            .select("court_id", "district_id", "court_no",
                    court_label("court_no").alias("court_name")))


class Normalised:
    """The seven tables plus ``proc_raw`` (typed cases, duplicates kept) and counts.

    Tables are built on first access, so asking for one table does not run the
    id-assignment jobs of the others.
    """

    def __init__(self, cases: DataFrame, districts: DataFrame, classes: DataFrame,
                 c: CaseCols = CaseCols(), d: DistrictCols = DistrictCols(),
                 k: ClassCols = ClassCols(), per_district: int = COURTS_PER_DISTRICT):
        self._cases, self._districts, self._classes = cases, districts, classes
        self._c, self._d, self._k, self._per = c, d, k, per_district
        self._codes = code_tables(cases.sparkSession)

    @cached_property
    def comarca(self) -> DataFrame:
        d = self._d
        return silver_districts(self._districts, d).select(
            F.col(d.district_id).alias("district_id"), F.col(d.name).alias("district_name"),
            F.col(d.uf).alias("uf"))

    @cached_property
    def classe(self) -> DataFrame:
        k = self._k
        return keep_any(self._classes.select(strict_int(k.class_id, "int").alias("class_id"),
                                             F.col(k.name).alias("class_name")), "class_id")

    @property
    def situacao(self) -> DataFrame:
        return self._codes["situacao"]

    @property
    def tipo_movimento(self) -> DataFrame:
        return self._codes["tipo_movimento"]

    @cached_property
    def vara(self) -> DataFrame:
        return courts(self.comarca, self._per)

    @cached_property
    def proc_raw(self) -> DataFrame:
        c = self._c
        typed = type_cases(self._cases, c).select(
            F.col(c.case_id).alias("case_id"), F.col(c.class_id).alias("class_id"),
            F.col(c.district_id).alias("district_id"), F.col(c.court_id).alias("court_no"),
            F.col(c.opened).alias("opened"), F.col(c.closed).alias("closed"))
        return semi_join(typed.filter(F.col("case_id").isNotNull()), self.comarca, "district_id")

    @cached_property
    def processo(self) -> DataFrame:
        located = self.proc_raw.join(self.vara.select("court_id", "district_id", "court_no"),
                                     ["district_id", "court_no"], "inner")
        return keep_any(located.select(
            "case_id",
            case_number("case_id", "district_id").alias("case_number"),
            "class_id", "court_id",
            F.when(F.col("closed").isNotNull(), F.lit(2)).otherwise(F.lit(1)).alias("status_id"),
            "opened"), "case_id")

    @cached_property
    def movimentacao(self) -> DataFrame:
        """Case events under any unique id: no order is asked for, so nothing is sorted or
        shuffled. The ids are those of the partitions, fixed once the table is written."""
        events = lifecycle_events(self.proc_raw, "case_id", "opened", "closed")
        return events.select((F.monotonically_increasing_id() + 1).alias("event_id"),
                             "case_id", "event_type_id", "event_date")

    TABLES = ("comarca", "vara", "classe", "situacao", "tipo_movimento", "processo",
              "movimentacao")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}

    @cached_property
    def counts(self) -> DataFrame:
        return table_counts(self.tables())

    STORED = ("comarca", "classe", "vara", "proc_raw", "processo", "movimentacao")

    def materialize(self, base_dir: str) -> "StoredModel":
        """Write all seven tables (plus ``proc_raw``) once and return them read back."""
        from strata.sinks.writers import write_tables

        stored = {}
        # Waves of independent tables; each wave reads the files of the earlier ones.
        for wave in (("comarca", "classe", "situacao", "tipo_movimento"), ("vara", "proc_raw"),
                     ("processo", "movimentacao")):
            written = write_tables({name: getattr(self, name) for name in wave}, base_dir)
            for name, df in written.items():
                stored[name] = df
                if name in self.STORED:
                    self.__dict__[name] = df
        return StoredModel(stored)


class StoredModel:
    """The normalised tables as written files (same attributes as ``Normalised``)."""

    TABLES = Normalised.TABLES

    def __init__(self, tables: dict[str, DataFrame]):
        self._t = tables
        for name, df in tables.items():
            setattr(self, name, df)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._t[name] for name in self.TABLES}

    @cached_property
    def counts(self) -> DataFrame:
        return table_counts(self.tables())


class LayeredModel(Normalised):
    """The model over a layer: each table is written on first use, from the files of those it
    needs, so asking for one table builds no other."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], layer):
        """``raw``: the extracts, each landed on first use. ``layer``: makes the mapping that
        holds the tables from ``{name: table}`` functions."""
        self._raw, self._codes, self._per = raw, code_tables(spark), COURTS_PER_DISTRICT
        self._c, self._d, self._k = CaseCols(), DistrictCols(), ClassCols()
        own = {name: getattr(Normalised, name) for name in dict.fromkeys((*self.TABLES, *self.STORED))}
        self._layer = layer({name: partial(getattr(v, "func", None) or v.fget, self) for name, v in own.items()})

    _cases = property(lambda self: self._raw["cases"])
    _districts = property(lambda self: self._raw["districts"])
    _classes = property(lambda self: self._raw["classes"])
    comarca = property(lambda self: self._layer["comarca"])
    vara = property(lambda self: self._layer["vara"])
    classe = property(lambda self: self._layer["classe"])
    situacao = property(lambda self: self._layer["situacao"])
    tipo_movimento = property(lambda self: self._layer["tipo_movimento"])
    proc_raw = property(lambda self: self._layer["proc_raw"])
    processo = property(lambda self: self._layer["processo"])
    movimentacao = property(lambda self: self._layer["movimentacao"])


def normalise(cases: DataFrame, districts: DataFrame, classes: DataFrame,
              c: CaseCols = CaseCols(), d: DistrictCols = DistrictCols(),
              k: ClassCols = ClassCols(), per_district: int = COURTS_PER_DISTRICT) -> Normalised:
    return Normalised(cases, districts, classes, c, d, k, per_district)
