"""Event-stream cleaning and copying on Spark: read, parse, deduplicate, flatten, write."""

from millrace.functions.avro_schema import parse_avro_schema
from millrace.operators.dedup import (
    dedup_bytes,
    dedup_json,
    dedup_json_rejects,
    dedup_records,
    dedup_records_rejects,
)
from millrace.operators.flatten import flatten, flatten_schema
from millrace.operators.parse import malformed_lines, parse_records
from millrace.session import build_session, scratch_folder
from millrace.sinks.events import append_events
from millrace.sources.events import as_text, read_events, stream_events, stream_info
from millrace.streaming.follow import follow

__all__ = [
    "append_events",
    "as_text",
    "build_session",
    "dedup_bytes",
    "dedup_json",
    "dedup_json_rejects",
    "dedup_records",
    "dedup_records_rejects",
    "flatten",
    "flatten_schema",
    "follow",
    "malformed_lines",
    "parse_avro_schema",
    "parse_records",
    "read_events",
    "scratch_folder",
    "stream_events",
    "stream_info",
]
