"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import CASE_NUMBER_FORMAT, CASE_NUMBER_MOD, COURT_LABEL_SUFFIX
from strata.functions._util import as_col


def title_case(c) -> Column:
    """Trim, lower-case, then capitalise the first letter after every space.

    Words are split on single spaces only (hyphens and apostrophes do not start
    a word); runs of spaces are kept.
    """
    return F.initcap(F.trim(as_col(c)))


def clean_code(c) -> Column:
    """Upper-cased, trimmed code such as a state abbreviation."""
    return F.upper(F.trim(as_col(c)))


def is_shouting(c) -> Column:
    """True when the text is entirely upper case (NULL for NULL)."""
    col = as_col(c)
    return col == F.upper(col)


def case_number(case_id, district_id, fmt: str = CASE_NUMBER_FORMAT,
                mod: int = CASE_NUMBER_MOD) -> Column:
    """Formatted case number from the numeric id and district."""
    return F.format_string(fmt, as_col(case_id) % F.lit(mod), as_col(district_id))


def court_label(number) -> Column:
    """``"<n>ª Vara"`` label of a court number."""
    return F.concat(as_col(number).cast("string"), F.lit(COURT_LABEL_SUFFIX))
