"""Text-faithful readers for raw CSV and JSON extracts (bronze input).

Bronze keeps values as text: typing is the silver layer's job, so every column is
read as ``string`` and nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.constants import PANDAS_NA_TOKENS


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                        columns: Sequence[str] | None = None) -> DataFrame:
    """Turn exact NA tokens (``NA``, ``null``, ``NaN``, empty …) into NULL."""
    cols = set(columns or df.columns)
    toks = list(tokens)
    return df.select(*[
        F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c)
        for c in df.columns])


CORRUPT = "_corrupt_record"
Columns = Sequence[str] | Mapping[str, str]


def column_mapping(columns: Columns) -> dict[str, str]:
    """``target -> source`` names; a plain list maps every name to itself."""
    return dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}


def checked(df: DataFrame, bad: Column, what: str, on_malformed: str) -> DataFrame:
    """Apply the rule for malformed records (``bad``; their text is in ``CORRUPT``).

    ``fail`` raises while the data is read, ``quarantine`` keeps them, marked by a
    non-null ``CORRUPT``, next to the good rows (whose ``CORRUPT`` is null).
    """
    text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[c for c in df.columns if c != CORRUPT])))
    if on_malformed == "fail":
        ok = F.when(bad, F.raise_error(F.concat(F.lit(f"malformed {what} record: "), text))).otherwise(F.lit(True))
        return df.filter(ok).drop(CORRUPT)
    if on_malformed == "quarantine":
        return df.withColumn(CORRUPT, F.when(bad, text))
    raise ValueError(f"on_malformed must be fail or quarantine, not {on_malformed!r}")


def csv_header(spark: SparkSession, path: str, multiline: bool = True, recursive: bool = False) -> list[str]:
    """Column names of a CSV extract (reads the first record only)."""
    return (spark.read.option("header", True).option("inferSchema", False).option("recursiveFileLookup", recursive)
                 .option("multiLine", multiline).option("escape", '"').csv(path).columns)


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Mapped columns under their target names, then the others as they are."""
    rest = [c for c in df.columns if c not in mapping.values() and c not in mapping]
    return df.select(*[F.col(f"`{src}`").alias(t) for t, src in mapping.items()], *[F.col(f"`{c}`") for c in rest])


def surplus_fields(n_columns: int) -> Column:
    """True for CSV records with more fields than the header. Shorter records are not
    malformed: their missing fields are null."""
    bare = F.regexp_replace(F.col(CORRUPT), '"([^"]|"")*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.col(CORRUPT).isNotNull() & (separators >= n_columns)


def read_csv_text(spark: SparkSession, path: str, columns: Columns | None = None,
                  null_tokens: Sequence[str] | None = PANDAS_NA_TOKENS,
                  multiline: bool = True, on_malformed: str = "fail") -> DataFrame:
    """CSV with a header row, every column as text, bound by header name.

    ``columns`` names the columns that must be there, in any order of the header; a
    mapping ``target -> header name`` renames them. Further columns are kept. All files
    under ``path`` must share one header (a deviating one is an error).
    ``multiline`` honours quoted newlines (a quoted field may span lines), at the price of
    one task per file; switch it off for large single-line extracts so files are split
    across tasks. ``""`` inside quotes is a literal quote. Records with surplus fields are
    malformed, see ``checked``.
    """
    header = csv_header(spark, path, multiline)
    mapping = column_mapping(columns if columns is not None else header)
    missing = [src for src in mapping.values() if src not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header} of {path}")
    df = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
               .option("enforceSchema", False).schema(text_schema([*header, CORRUPT])).csv(path))
    df = renamed(checked(df, surplus_fields(len(header)), "CSV", on_malformed), mapping)
    return null_tokens_to_null(df, null_tokens, [c for c in df.columns if c != CORRUPT]) if null_tokens else df


def unreadable_json(fields: Sequence[str]) -> Column:
    """True for text that is no JSON record and for records with none of the fields."""
    bad = F.col(CORRUPT).isNotNull()
    return bad | (F.coalesce(*[F.col(f"`{c}`") for c in fields]).isNull()) if fields else bad


def read_json_text(spark: SparkSession, path: str, columns: Columns | None = None,
                   array: bool = True, on_malformed: str = "fail") -> DataFrame:
    """JSON records as text columns, bound by key.

    ``array=True`` reads a document holding one array of objects (one task per
    file); prefer JSON-lines (``array=False``) for large feeds — those split.
    Numbers keep their literal text (``8000001`` stays ``'8000001'``); JSON null
    stays NULL. ``columns`` names the keys (or maps ``target -> key``); a record that is
    no JSON, or has none of the keys, is malformed, see ``checked``.
    """
    reader = (spark.read.option("multiLine", array).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", CORRUPT))
    if columns is None:
        df = reader.option("primitivesAsString", True).json(path)
        if CORRUPT not in df.columns:
            return df
        df = reader.schema(df.schema).json(path)
        return checked(df, F.col(CORRUPT).isNotNull(), "JSON", on_malformed)
    mapping = column_mapping(columns)
    df = reader.schema(text_schema([*mapping.values(), CORRUPT])).json(path)
    return renamed(checked(df, unreadable_json(list(mapping.values())), "JSON", on_malformed), mapping)


def count_records(spark: SparkSession, fmt: str, path: str, array: bool = True,
                  multiline: bool = True) -> DataFrame:
    """``(n)``: records of a raw extract, counted on its text and not by the parser.

    Single-line formats count non-blank lines (less one header per CSV file), in splits.
    A multi-line CSV counts line ends outside quotes and a JSON array its elements, file
    by file, like the readers of these forms.
    """
    filled = ~F.regexp_like("value", F.lit(r"^\s*$"))
    if fmt == "csv" and multiline:
        bare = F.regexp_replace("value", '"([^"]|"")*"', "q")
        lines = F.regexp_count(bare, F.lit(r"(?m)^.*\S.*$"))
        return spark.read.text(path, wholetext=True).agg(
            F.coalesce(F.sum(F.greatest(lines - 1, F.lit(0))), F.lit(0)).cast("long").alias("n"))
    if fmt == "json" and array:
        return spark.read.text(path, wholetext=True).agg(
            F.coalesce(F.sum(F.json_array_length("value")), F.lit(0)).cast("long").alias("n"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f")).filter(filled)
    if fmt == "csv":
        return (lines.groupBy("f").agg((F.count(F.lit(1)) - 1).alias("n"))
                     .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")))
    return lines.agg(F.count(F.lit(1)).alias("n"))
