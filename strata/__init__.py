"""strata — a Spark-native medallion lakehouse toolkit.

Layers: text-faithful bronze ingestion, typed/cleaned silver, a star-schema gold
(duration measure, conformed dimensions, generated role-playing calendar),
declarative data-quality rules, profiling reports, a snapshot→event-sourced
normaliser and duration reports. Every operator is a lazy ``DataFrame -> DataFrame``
(or ``Column -> Column``) function with column names as parameters.
"""

from strata.session import build_session, scratch_dir


def __getattr__(name):
    # Convenience entry points, imported on first use.
    if name in ("build_lakehouse", "open_lakehouse", "default_rules"):
        from strata.plans import lakehouse
        return getattr(lakehouse, name)
    if name == "normalise":
        from strata.plans.normalise import normalise
        return normalise
    if name == "reports":
        from strata.plans import reports
        return reports
    raise AttributeError(name)


__all__ = ["build_session", "scratch_dir", "build_lakehouse", "open_lakehouse", "default_rules",
           "normalise", "reports"]
