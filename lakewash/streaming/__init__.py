"""Incremental (Structured Streaming) forms of the jobs and checks."""

from lakewash.streaming.incremental import (
    flat_record_source, key_table, run_flat_record_load, run_nested_record_load, start_flat_record_load,
    start_nested_record_load, text_schema_from_header,
)
from lakewash.streaming.keys import KeyTable
from lakewash.streaming.orphans import run_orphan_report, stream_orphans

__all__ = ["KeyTable", "flat_record_source", "key_table", "run_flat_record_load", "run_nested_record_load",
           "run_orphan_report", "start_flat_record_load", "start_nested_record_load", "stream_orphans",
           "text_schema_from_header"]
