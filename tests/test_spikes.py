"""Spike rule over windowed counts (A7, W1) on hand-made sequences."""

import datetime as dt

from tidewatch.config import DEFAULTS
from tidewatch.operators import spikes, spikes_from_counts

T0 = dt.datetime(2024, 1, 1)


def _counts(spark, title, counts):
    rows = [(title, T0 + dt.timedelta(minutes=i), T0 + dt.timedelta(minutes=i + 1), n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "title string, window_start timestamp, window_end timestamp, edit_count long")


def _scored(spark, counts):
    return [tuple(r) for r in spikes_from_counts(_counts(spark, "P", counts))
            .orderBy("window_start").select("historical_average", "spike_multiplier", "is_spike").collect()]


def test_five_times_is_not_a_spike_six_is(spark):
    assert _scored(spark, [1, 5])[1] == (1.0, 5.0, False)
    assert _scored(spark, [1, 6])[1] == (1.0, 6.0, True)


def test_first_window_has_no_history(spark):
    assert _scored(spark, [100])[0] == (0.0, 0.0, False)


def test_only_last_ten_windows_form_the_average(spark):
    got = _scored(spark, list(range(1, 13)))
    assert got[11][0] == sum(range(2, 12)) / 10
    assert got[10][0] == sum(range(1, 11)) / 10


def test_titles_are_independent_and_from_events(spark):
    ev = []
    for k in range(3):  # P: 1 edit per minute, then 7 in one minute
        ev.append(("P", T0 + dt.timedelta(minutes=k, seconds=1)))
    ev += [("P", T0 + dt.timedelta(minutes=3, seconds=s)) for s in range(7)]
    ev += [("Q", T0 + dt.timedelta(minutes=3, seconds=5))]
    df = spark.createDataFrame(ev, "title string, event_time timestamp")
    rows = {(r.article_title, r.window_start.minute): r for r in spikes(df, DEFAULTS).collect()}
    assert rows[("P", 3)].is_spike and rows[("P", 3)].current_edit_count == 7
    assert not rows[("Q", 3)].is_spike and rows[("Q", 3)].historical_average == 0.0
