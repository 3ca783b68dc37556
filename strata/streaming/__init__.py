"""Structured Streaming: incremental bronze ingestion of a landing folder."""

from strata.streaming.bronze_stream import (ingest_available, read_landing, stamp_batches,
                                            start_bronze_stream)

__all__ = ["ingest_available", "read_landing", "stamp_batches", "start_bronze_stream"]
