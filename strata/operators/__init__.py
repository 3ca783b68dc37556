"""DataFrame -> DataFrame operators (lazy; no actions except where documented)."""

from strata.operators.calendar import calendar, calendar_bounds
from strata.operators.counts import table_counts
from strata.operators.dedup import distinct_typed, keep_any, keep_preferred, prefer_not_shouting
from strata.operators.events import first_event, first_event_by_code, lifecycle_events
from strata.operators.keys import dense_ids
from strata.operators.measures import (distinct_per, duration_by, fanout_mean, grain_mean,
                                       grain_report)
from strata.operators.profile import (duplicate_keys, missing_ids, mixed_formats, orphans,
                                      schema_drift, spelling_variants, values_with)
from strata.operators.quality import (Rule, accepted_values, ingestion_checks, not_null,
                                      relationships, run_suite, unique)
from strata.operators.star import Dim, anti_join, build_fact, role_dim, semi_join, star_join

__all__ = [
    "calendar", "calendar_bounds", "table_counts", "distinct_typed", "keep_any",
    "keep_preferred", "prefer_not_shouting", "first_event", "first_event_by_code",
    "lifecycle_events", "dense_ids", "distinct_per", "duration_by", "fanout_mean",
    "grain_mean", "grain_report", "duplicate_keys", "missing_ids", "mixed_formats",
    "orphans", "schema_drift", "spelling_variants", "values_with", "Rule",
    "accepted_values", "ingestion_checks", "not_null", "relationships", "run_suite",
    "unique", "Dim", "anti_join", "build_fact", "role_dim", "semi_join", "star_join",
]
