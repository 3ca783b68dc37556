"""Writers: stamped bronze Parquet, full-refresh tables, serving views."""

from strata.sinks.writers import (batch_timestamp, register_view, write_bronze, write_table,
                                  write_tables)

__all__ = ["batch_timestamp", "register_view", "write_bronze", "write_table", "write_tables"]
