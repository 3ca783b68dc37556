"""Lenient and strict casts from bronze text (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions._util import as_col

_INT_TYPES = {"bigint": T.LongType(), "long": T.LongType(), "int": T.IntegerType(),
              "integer": T.IntegerType(), "smallint": T.ShortType()}

# A value is an ISO-like date when it is (after blanks) a 1-7 digit year, a dash or
# slash, a 1-2 digit month, the *same* separator and a 1-2 digit day, followed
# either by nothing but blanks or by a valid clock time (HH:MM[:SS[.fff]]), after
# which anything may follow. Bare years are not dates. Year 0 is rejected: it would be
# 1 BC, which no case data means and which most clients cannot represent.
ISO_LIKE = (r"^\s*(?!0+[-/])([0-9]{1,7})([-/])([0-9]{1,2})\2([0-9]{1,2})"
            r"(?:\s*$|[ T](?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]*)?)?)")
# Day-first dates (d/M/yyyy) with 1-2 digit day and month and a 1-4 digit year,
# blanks around allowed.
DAY_FIRST = r"^\s*([0-9]{1,2})/([0-9]{1,2})/(?!0+\s*$)([0-9]{1,4})\s*$"


def _rewritten_date(col: Column, pattern: str, year: int, month: int, day: int) -> Column:
    """DATE from the groups of ``pattern``, NULL when it does not match or names no day.

    The match is rewritten to ``y-m-d`` (anything else to ``--``, which is no date), short
    years are padded, and the text is cast once. Each step is written once, never in the branches
    of a condition: the code Spark generates for a row must stay small enough to be compiled.
    """
    ymd = F.regexp_replace(col, rf"(?s){pattern}.*$|^.*$", f"${year}-${month}-${day}")
    return F.regexp_replace(ymd, "^([0-9]{1,3})-", "000$1-").try_cast(T.DateType())


def _drop_digit_separators(col: Column, digits: str) -> Column:
    """Remove single underscores that sit between two ``digits`` (``1_000`` → ``1000``).

    Only values containing ``_`` pay for the regex."""
    pattern = rf"(?<=[{digits}])_(?=[{digits}])"
    return F.when(col.contains("_"), F.regexp_replace(col, pattern, "")).otherwise(col)


def _radix_value(text: Column, mark: str, digits: str, base: int, most: int) -> Column:
    """Decimal text of ``0x…`` / ``0b…`` values, NULL for other text and for values of more
    than ``most`` digits after leading zeros (beyond 64 bits), which become no digits."""
    bare = F.regexp_replace(text, rf"(?s)^0{mark}0*([{digits}]{{1,{most}}})$|^.*$", "$1")
    return F.conv(bare, base, 10)


def safe_int(c, type_name: str = "bigint") -> Column:
    """Lenient integer cast: NULL instead of an error.

    Text such as ``'8000001.0'`` or ``'1e3'`` is a valid integer (rounded half
    away from zero), so the value goes through a wide decimal first; ``0x1F``,
    ``0b101`` and digit separators (``1_000``, ``0x1_0``) are read too.
    """
    target = _INT_TYPES[type_name]
    col = as_col(c)
    # Scale 0: the text is rounded once, whatever the number of its decimals.
    as_decimal = _drop_digit_separators(col, "0-9").try_cast(T.DecimalType(38, 0))
    hex_value = _radix_value(_drop_digit_separators(col, "0-9A-Fa-f"), "[xX]", "0-9a-fA-F", 16, 16)
    bin_value = _radix_value(_drop_digit_separators(col, "01"), "[bB]", "01", 2, 64)
    return F.coalesce(as_decimal.try_cast(target), F.coalesce(hex_value, bin_value).try_cast(target))


def strict_int(c, type_name: str = "int") -> Column:
    """Fail-fast integer cast (raises on bad text; ANSI mode)."""
    return as_col(c).cast(_INT_TYPES[type_name])


def iso_date(c) -> Column:
    """ISO-like text (``yyyy-M-d`` or ``yyyy/M/d``, optional clock time) to DATE, else NULL."""
    return _rewritten_date(as_col(c), ISO_LIKE, 1, 3, 4)


def day_first_date(c) -> Column:
    """Day-first text ``d/M/yyyy`` (blanks around allowed) to DATE, else NULL."""
    return _rewritten_date(as_col(c), DAY_FIRST, 3, 2, 1)


def pattern_date(c, pattern: str) -> Column:
    """Text in a datetime ``pattern`` to DATE, else NULL (Spark's parser)."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast(T.DateType())


def parse_mixed_date(c, formats=("iso", "d/M/yyyy")) -> Column:
    """First successful parse over an ordered list of formats.

    ``"iso"`` and ``"d/M/yyyy"`` are regex-driven parsers (no exception per failed
    row); any other entry is a Spark datetime pattern.
    """
    named = {"iso": iso_date, "d/M/yyyy": day_first_date}
    parsers = [named[f](c) if f in named else pattern_date(c, f) for f in formats]
    return parsers[0] if len(parsers) == 1 else F.coalesce(*parsers)
