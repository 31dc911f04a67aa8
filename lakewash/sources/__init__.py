"""Readers and sinks."""

from lakewash.sources.readers import (
    CORRUPT_RECORD, CSV_DIALECT, path_exists, read_csv, read_data, read_jdbc, read_json,
    read_parquet, require_path,
)
from lakewash.sources.sinks import (
    SinkUnavailable, empty_as_null, load_jdbc, staged_refresh, staged_refresh_jdbc, write_csv,
    write_data, write_delta, write_observed, write_parquet,
)

__all__ = [
    "CORRUPT_RECORD", "CSV_DIALECT", "SinkUnavailable", "empty_as_null", "load_jdbc", "path_exists",
    "read_csv", "read_data", "read_jdbc", "read_json", "read_parquet", "require_path", "staged_refresh",
    "staged_refresh_jdbc", "write_csv", "write_data", "write_delta", "write_observed", "write_parquet",
    "write_table",
]
