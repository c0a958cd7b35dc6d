"""Named batch queries over the driver tables, one per operator family.

Each builder takes (spark, sf_dir) and returns a DataFrame over the *whole*
``events`` table; timestamps are returned as TIMESTAMP_NTZ (UTC wall clock) so
they compare directly with zone-less SQL engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Params
from tidewatch.functions.columns import to_ntz
from tidewatch.operators import editor_running, editor_spans, minute_counts, spikes, trending
from tidewatch.plans.serve import active_board, hourly_heatmap_from_events, spike_board, top_trending_from_events
from tidewatch.session import ensure_utc, scratch_path
from tidewatch.sources import change_events, edits, parse_changes, read_result, read_table, with_event_time
from tidewatch.sources.ingest import raw_change_json

# Oracle-checkable spike setting: at the test densities one-minute windows
# nearly always hold a single edit, so the default rule finds nothing.
WIDE_SPIKES = DEFAULTS.with_(spike_window="6 hours", spike_multiplier=2.0)

EVOLVED_AT = "2024-01-16 00:00:00"  # first window that the later version wrote in ``evolved_counts``


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return edits(change_events(spark, sf_dir))


def q_parse_changes(spark, sf_dir):
    """P1-P6 on the wire form: every event serialised to JSON, parsed back."""
    ensure_utc(spark)
    raw = change_events(spark, sf_dir).select(raw_change_json().alias("value"))
    return to_ntz(with_event_time(parse_changes(raw, "value")))


def q_trending_sliding(spark, sf_dir):
    return to_ntz(trending(_edits(spark, sf_dir), method="direct"))


def q_trending_prebucketed(spark, sf_dir):
    return to_ntz(trending(_edits(spark, sf_dir), method="prebucketed"))


def q_minute_counts(spark, sf_dir):
    return to_ntz(minute_counts(_edits(spark, sf_dir)))


def q_spikes_batch(spark, sf_dir):
    return to_ntz(spikes(_edits(spark, sf_dir)))


def q_spikes_wide(spark, sf_dir):
    return to_ntz(spikes(_edits(spark, sf_dir), WIDE_SPIKES))


def q_editor_spans(spark, sf_dir):
    return to_ntz(editor_spans(_edits(spark, sf_dir)))


def q_editor_running(spark, sf_dir):
    return to_ntz(editor_running(_edits(spark, sf_dir)))


def q_top_trending(spark, sf_dir):
    e = _edits(spark, sf_dir)
    newest = e.select(F.max("event_time")).scalar()
    return to_ntz(top_trending_from_events(e, as_of=newest))


def q_top_trending_distinct(spark, sf_dir):
    e = _edits(spark, sf_dir)
    newest = e.select(F.max("event_time")).scalar()
    return to_ntz(top_trending_from_events(e, as_of=newest, lookback="1 day", mode="distinct_edits"))


def q_active_board(spark, sf_dir):
    return to_ntz(active_board(editor_spans(_edits(spark, sf_dir)), version_cols=("span_start",)))


def q_spike_board(spark, sf_dir):
    return to_ntz(spike_board(spikes(_edits(spark, sf_dir), WIDE_SPIKES)))


def q_hourly_heatmap(spark, sf_dir):
    return to_ntz(hourly_heatmap_from_events(_edits(spark, sf_dir)))


def q_evolved_counts(spark, sf_dir):
    """A table of minute counts that two versions of a job wrote: until ``EVOLVED_AT`` without
    the window's end and with counts as int; read under the later schema."""
    counts = minute_counts(_edits(spark, sf_dir))
    path = scratch_path(spark, "evolved-counts")
    later = F.col("window_start") >= F.lit(EVOLVED_AT).cast("timestamp")
    (counts.where(~later).select("title", "window_start", F.col("edit_count").cast("int")).write.parquet(path))
    counts.where(later).write.mode("append").parquet(path)
    return to_ntz(read_result(spark, path, schema=counts.schema))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_changes": q_parse_changes,
    "trending_sliding": q_trending_sliding,
    "trending_prebucketed": q_trending_prebucketed,
    "minute_counts": q_minute_counts,
    "spikes_batch": q_spikes_batch,
    "spikes_wide": q_spikes_wide,
    "editor_spans": q_editor_spans,
    "editor_running": q_editor_running,
    "top_trending": q_top_trending,
    "top_trending_distinct": q_top_trending_distinct,
    "active_board": q_active_board,
    "spike_board": q_spike_board,
    "hourly_heatmap": q_hourly_heatmap,
    "evolved_counts": q_evolved_counts,
}

__all__ = ["BATCH_QUERIES", "WIDE_SPIKES", "read_table", "Params"]
