from tidewatch.sources.changes import read_table, changes_from_events, change_events
from tidewatch.sources.ingest import (
    parse_changes, with_event_time, watermarked, deduplicated, edits, from_kafka, from_json_files,
    kafka_reader_options, publish_raw,
)
from tidewatch.sources.results import read_result, register_result, as_of

__all__ = [
    "read_table", "changes_from_events", "change_events", "parse_changes", "with_event_time",
    "watermarked", "deduplicated", "edits", "from_kafka", "from_json_files", "kafka_reader_options",
    "publish_raw", "read_result", "register_result", "as_of",
]
