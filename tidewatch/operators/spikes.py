"""A2 / T4 minute counts and the spike rule.

Batch twin of the stateful spike detector: each (title, window) is counted
once, windows of a title are taken in ``window_start`` order, and the current
count is compared with the mean of the previous <= ``history`` counts:

    historical_average = mean of the previous <= 10 counts (0.0 if none)
    spike_multiplier   = 0.0 if the average is 0 else count / average
    is_spike           = history exists and count > average * multiplier

The window function is partitioned by title over the *aggregated* table (one
row per title and minute), so a title's partition is bounded by the number of
windows in the time range, not by its number of edits: a title holding a third
of all edits still produces at most one row per minute.

``spike_step`` is the same rule as a pure function on a history list; the
streaming processor and the unit tests use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, SPIKE_HISTORY, SPIKE_MULTIPLIER, Params
from tidewatch.functions.columns import guarded_ratio, spike_flag, window_bounds


def minute_counts(events: DataFrame, params: Params = DEFAULTS, time_col: str = "event_time") -> DataFrame:
    """A2: edits per (tumbling window, title); wikis are merged."""
    counted = events.groupBy(F.window(time_col, params.spike_window).alias("window"), F.col("title")).agg(
        F.count(F.lit(1)).alias("edit_count")
    )
    return counted.select(F.col("title"), *window_bounds("window"), F.col("edit_count").cast("long"))


def spikes_from_counts(counts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """W1 over windowed counts (title, window_start, window_end, edit_count)."""
    w = Window.partitionBy("title").orderBy("window_start").rowsBetween(-params.spike_history, -1)
    n = F.col("edit_count")
    avg = F.avg(n).over(w)
    has_hist = F.count(n).over(w) > 0
    return counts.select(
        F.col("title").alias("article_title"),
        F.col("window_start"),
        F.col("window_end"),
        n.alias("current_edit_count"),
        F.coalesce(avg, F.lit(0.0)).alias("historical_average"),
        guarded_ratio(n, avg).alias("spike_multiplier"),
        spike_flag(n, avg, has_hist, params.spike_multiplier).alias("is_spike"),
    )


def spikes(events: DataFrame, params: Params = DEFAULTS, time_col: str = "event_time") -> DataFrame:
    """edit_spikes rows from edits, one per (title, window)."""
    return spikes_from_counts(minute_counts(events, params, time_col), params)


def spike_step(history: list[int], count: int, keep: int = SPIKE_HISTORY, multiplier: float = SPIKE_MULTIPLIER):
    """Pure form of the rule: returns (average, ratio, is_spike, new_history)."""
    avg = (sum(history) / len(history)) if history else 0.0
    is_spike = bool(history) and count > avg * multiplier
    ratio = 0.0 if avg == 0.0 else count / avg
    new_hist = (list(history) + [int(count)])[-keep:]
    return avg, ratio, is_spike, new_hist
