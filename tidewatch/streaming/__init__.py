from tidewatch.streaming.app import await_all, await_any, checkpoint_paths, start_all, stop_all, table_paths
from tidewatch.streaming.current import current_table_writer, read_current
from tidewatch.streaming.jobs import (
    editors_frame, sessions_frame, spikes_frame, start_editors, start_sessions, start_spikes, start_trending, trending_frame,
)
from tidewatch.streaming.late import late_rows_writer, start_late
from tidewatch.streaming.sinks import append_stream, idempotent_batch_writer, update_stream

__all__ = [
    "await_all", "await_any", "checkpoint_paths", "start_all", "stop_all", "table_paths",
    "editors_frame", "sessions_frame", "spikes_frame", "start_editors", "start_sessions", "start_spikes", "start_trending",
    "trending_frame", "late_rows_writer", "start_late", "current_table_writer", "read_current",
    "append_stream", "idempotent_batch_writer", "update_stream",
]
