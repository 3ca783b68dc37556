"""Column types of text extracts, inferred from all their rows.

One aggregate over the table counts, per column, the values that each kind of literal covers
(``state``). Counts add up, so states of files or batches merge (``merged``), and the type of
a column is the narrowest kind that covers all its values (``types_of``):

    boolean < bigint < decimal(38,0) < double, date < timestamp, everything < string

A column without any value is text. Numbers with leading zeros or a plus sign are codes, so
text; dates are year-first, or day-first, or month-first (in this order of preference, one
order for the whole column) with ``-`` or ``/``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.text_files import CORRUPT

_WHOLE = r"^-?(0|[1-9][0-9]*)$"
_REAL = r"^(-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[nN][aA][nN])$"
_TRUE, _FALSE = ("true", "t", "yes", "y"), ("false", "f", "no", "n")
_TIME = r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?"
_YEAR_FIRST, _YEAR_LAST = r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}", r"[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}"


def _date(v: Column, pattern: str, fmt: str) -> Column:
    """The parser sees only text of the right shape, so other values cost no failed parse."""
    return F.when(F.regexp_like(v, F.lit(f"^{pattern}$")), F.try_to_date(F.replace(v, F.lit("/"), F.lit("-")), fmt))


def _boolean(v: Column) -> Column:
    low = F.lower(v)
    return F.when(low.isin(*_TRUE), F.lit(True)).when(low.isin(*_FALSE), F.lit(False))


def _whole(kind: str):
    return lambda v: F.when(F.regexp_like(v, F.lit(_WHOLE)), v.try_cast(kind))


def _double(v: Column) -> Column:
    return F.when(F.regexp_like(v, F.lit(_REAL)), F.when(F.lower(v) == "nan", F.lit(float("nan"))).otherwise(v.try_cast("double")))


def _timestamp(v: Column) -> Column:
    return F.when(F.regexp_like(v, F.lit(f"^{_YEAR_FIRST}{_TIME}$")), F.replace(v, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"))


#: Kind -> (type, parser of trimmed text that gives null where the kind does not cover it), narrowest first.
KINDS = {
    "boolean": ("boolean", _boolean),
    "bigint": ("bigint", _whole("bigint")),
    "huge": ("decimal(38,0)", _whole("decimal(38,0)")),
    "double": ("double", _double),
    "date_ymd": ("date", lambda v: _date(v, _YEAR_FIRST, "yyyy-M-d")),
    "date_dmy": ("date", lambda v: _date(v, _YEAR_LAST, "d-M-yyyy")),
    "date_mdy": ("date", lambda v: _date(v, _YEAR_LAST, "M-d-yyyy")),
    "timestamp": ("timestamp_ntz", _timestamp),
}


def state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n_rows, n_null, max_chars, <one count per kind>)``: one pass over ``df``,
    one row per text column. Null and empty text is no value."""
    columns = [c for c in (columns or df.columns) if c != CORRUPT]
    fields = ["n_rows", "n_null", "max_chars", *KINDS]

    def of(c: str) -> Column:
        v = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        counts = [F.count(F.lit(1)), F.count_if(v.isNull()), F.coalesce(F.max(F.length(f"`{c}`")), F.lit(0)).cast("bigint")]
        counts += [F.count(parse(v)) for _, parse in KINDS.values()]
        return F.struct(F.lit(c).alias("column_name"), *[x.alias(n) for x, n in zip(counts, fields)])

    one = df.agg(F.array(*map(of, columns)).alias("s"))
    return one.select(F.inline("s"))


def merged(states: Sequence[DataFrame]) -> DataFrame:
    """The state of several batches together; a column that a batch lacks has no rows there."""
    every = reduce(lambda a, b: a.unionByName(b), states)
    return every.groupBy("column_name").agg(*[(F.max if c == "max_chars" else F.sum)(c).cast("bigint").alias(c)
                                             for c in every.columns if c != "column_name"])


def types_of(states: DataFrame) -> DataFrame:
    """``(column_name, kind, type, n_rows, n_null, max_chars)``."""
    values = F.col("n_rows") - F.col("n_null")
    kind = F.coalesce(*[F.when((values > 0) & (F.col(k) == values), F.lit(k)) for k in KINDS], F.lit("text"))
    types = F.create_map(*[F.lit(x) for k, (t, _) in KINDS.items() for x in (k, t)], F.lit("text"), F.lit("string"))
    return states.select("column_name", kind.alias("kind"), "n_rows", "n_null", "max_chars").select(
        "column_name", "kind", types[F.col("kind")].alias("type"), "n_rows", "n_null", "max_chars")


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``df`` with the named columns parsed as their kinds; the others as they are. A value that
    its kind does not cover (of a batch the state does not include) is an error, not a null."""
    def parsed(c: str) -> Column:
        own = F.col(f"`{c}`")
        if kinds.get(c, "text") == "text":
            return F.nullif(own, F.lit("")).alias(c) if c in kinds else own
        v = F.nullif(F.trim(own), F.lit(""))
        out = KINDS[kinds[c]][1](v)
        wrong = F.raise_error(F.concat(F.lit(f"column {c}: no {kinds[c]}: "), v)).cast(KINDS[kinds[c]][0])
        return F.when(v.isNull(), F.lit(None)).otherwise(F.coalesce(out, wrong)).alias(c)

    return df.select(*map(parsed, df.columns))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns typed by all their values: an aggregate over ``df``, whose one row per
    column comes to the driver, then the casts."""
    columns = [c for c in (columns or df.columns) if c != CORRUPT]
    return typed(df, {r["column_name"]: r["kind"] for r in types_of(state(df, columns)).collect()})


def read_csv_inferred(spark: SparkSession, path: str, columns=None, **options) -> DataFrame:
    """``read_csv_text`` with inferred types. Empty fields are the only nulls, unless
    ``null_tokens`` says otherwise."""
    from strata.sources.text_files import read_csv_text

    return infer_types(read_csv_text(spark, path, columns, **{"null_tokens": ("",), **options}))
