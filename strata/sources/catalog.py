"""Named Parquet sources resolved through a path template."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceCatalog:
    """``{name}`` → Parquet location, e.g. ``/lake/bronze/{name}.parquet``."""
    template: str

    def path(self, name: str) -> str:
        return self.template.format(name=name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    def register(self, spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
        """Read each source and register it as a temporary view of the same name."""
        out = {}
        for n in names:
            df = self.read(spark, n)
            df.createOrReplaceTempView(n)
            out[n] = df
        return out


def parquet_path_sql(spark: SparkSession, path: str, select_sql: str, alias: str = "t") -> DataFrame:
    """Run SQL whose FROM is a Parquet path (``select … from parquet.`path` t``).

    ``select_sql`` holds a ``{src}`` placeholder for the path table.
    """
    src = f"parquet.`{path}` {alias}"
    return spark.sql(select_sql.format(src=src))


def preview(df: DataFrame, n: int = 10, order=None) -> DataFrame:
    """The first ``n`` rows for a look at a table (``LIMIT n``; with ``order`` the top
    ``n`` by it). Unordered, Spark stops reading once ``n`` rows are found; ordered,
    every task keeps only its own top ``n``, so the table is scanned but never sorted
    or shuffled as a whole."""
    return (df.orderBy(*order) if order else df).limit(n)
