"""Column -> Column functions (all built-in Spark expressions, codegen-friendly)."""

from strata.functions.casts import (ISO_LIKE, iso_date, parse_mixed_date, pattern_date,
                                    safe_int, strict_int)
from strata.functions.dates import duration_days, is_weekend, month_name
from strata.functions.text import case_number, clean_code, court_label, is_shouting, title_case

__all__ = [
    "ISO_LIKE", "iso_date", "parse_mixed_date", "pattern_date", "safe_int", "strict_int",
    "duration_days", "is_weekend", "month_name",
    "case_number", "clean_code", "court_label", "is_shouting", "title_case",
]
