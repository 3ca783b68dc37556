"""Readers: text-faithful CSV/JSON, named Parquet sources, file-level audits."""

from strata.sources.catalog import SourceCatalog, parquet_path_sql, preview
from strata.sources.files import file_sizes, list_files
from strata.sources.text_files import count_records, null_tokens_to_null, read_csv_text, read_json_text, text_schema

__all__ = ["SourceCatalog", "parquet_path_sql", "preview", "file_sizes", "list_files",
           "count_records", "null_tokens_to_null", "read_csv_text", "read_json_text", "text_schema"]
