"""Editor spans and running totals (W2, W3) against a brute-force sessionizer."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from data_dirs import SF001
from tidewatch.operators import editor_running, editor_spans
from tidewatch.plans.registry import _edits

HOUR = 3600
T0 = dt.datetime(2024, 1, 1)


def brute(rows):
    """rows: (user, id, seconds). Returns {(user, id): (span_start_s, total)} by a plain scan."""
    out = {}
    by_user = {}
    for u, i, s in rows:
        by_user.setdefault(u, []).append((s, i))
    for u, evs in by_user.items():
        evs.sort()
        prev, start, n = None, None, 0
        for s, i in evs:
            if prev is None or s - prev >= HOUR:
                start, n = s, 0
            n += 1
            out[(u, i)] = (start, n)
            prev = s
    return out


def _frame(spark, rows):
    data = [(u, i, T0 + dt.timedelta(seconds=s)) for u, i, s in rows]
    return spark.createDataFrame(data, "user string, id long, event_time timestamp")


def _check(spark, rows, bucket=None):
    got = editor_running(_frame(spark, rows), bucket=bucket).collect()
    exp = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        start_s, total = exp[(r.user, r.id)]
        assert r.total_edits == total, (r, start_s, total)
        assert r.span_start == T0 + dt.timedelta(seconds=start_s), (r, start_s)
        assert r.last_activity == r.event_time


def test_gap_of_exactly_one_hour_splits(spark):
    _check(spark, [("a", 1, 0), ("a", 2, HOUR), ("a", 3, 2 * HOUR - 1), ("a", 4, 3 * HOUR + 10)])


def test_span_crossing_many_buckets(spark):
    # one edit every 50 minutes for two days: a single span over ~58 hour buckets
    _check(spark, [("bot", i, i * 3000) for i in range(58)])


def test_ties_and_null_editor(spark):
    rows = [("a", 1, 100), ("a", 2, 100), ("a", 3, 100 + HOUR), (None, 4, 5), (None, 5, 10), (None, 6, 5 + 2 * HOUR)]
    _check(spark, rows)


@pytest.mark.parametrize("bucket", [None, "1 minute", "7 minutes", "3 hours"])
def test_random_against_brute_force_with_hot_editor(spark, bucket):
    rng = random.Random(7)
    rows, i = [], 0
    # a hot editor owning a third of all rows, dense enough to chain across buckets
    users = ["hot"] * 600 + [f"u{k}" for k in range(60) for _ in range(20)]
    clocks = {}
    for u in users:
        gap = rng.choice([5, 60, 600, 3000, 3599, 3600, 3601, 7200, 20000])
        clocks[u] = clocks.get(u, rng.randint(0, 10_000)) + gap
        rows.append((u, i, clocks[u]))
        i += 1
    rng.shuffle(rows)
    _check(spark, rows, bucket)


def test_spans_and_expiry(spark):
    rows = [("a", 1, 0), ("a", 2, 600), ("b", 3, 0), ("b", 4, 5 * HOUR), ("c", 5, 5 * HOUR + 1800)]
    got = {(r.user, r.span_start): r for r in editor_spans(_frame(spark, rows)).collect()}
    assert len(got) == 4
    a = got[("a", T0)]
    assert a.total_edits == 2 and a.last_activity == T0 + dt.timedelta(seconds=600) and a.is_expired
    # newest edit at 5h30m: watermark 5h20m; b's second span ends 5h + 1h > 5h20m -> open
    assert not got[("b", T0 + dt.timedelta(hours=5))].is_expired
    assert got[("b", T0)].is_expired


def test_hot_editor_not_windowed_alone(spark):
    """The row pass is partitioned by (user, bucket), never by user alone."""
    rows = [("hot", i, i * 10) for i in range(50)]
    plan = editor_running(_frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    import re

    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        parts = [p.strip() for p in spec.split(",")]
        # the per-row windows carry the bucket key next to user
        if any("_t#" in p for p in parts):
            assert any(p.startswith("_b#") for p in parts), spec


def test_session_window_plan_agrees(spark):
    from tidewatch.plans.registry import _edits

    from data_dirs import SF01

    e = _edits(spark, SF01)
    a = editor_spans(e)
    b = editor_spans(e, method="session_window")
    assert a.count() == 5641
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_spans_scan_and_shuffle_the_rows_once(spark):
    from tidewatch.operators.editors import _merged_spans
    from tidewatch.config import DEFAULTS
    plan = _final_plan(_merged_spans(_edits(spark, SF001), DEFAULTS, "event_time", None))
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


def test_running_totals_read_the_rows_once(spark):
    plan = _final_plan(editor_running(_edits(spark, SF001)))
    assert plan.count("Scan parquet") - plan.count("ReusedExchange") <= 1
