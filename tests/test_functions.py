"""Pure rules and column helpers."""

import pytest
from pyspark.sql import functions as F

from tidewatch.config import duration_us
from tidewatch.functions.columns import guarded_ratio, history_mean, is_blank, push_history, round2
from tidewatch.operators.editors import editor_step
from tidewatch.operators.spikes import spike_step


def test_duration_parsing():
    assert duration_us("10 minutes") == 600_000_000
    assert duration_us("30 seconds") == 30_000_000
    assert duration_us("1 hour") == 3_600_000_000
    assert duration_us("1 hour 30 minutes") == 5_400_000_000
    with pytest.raises(ValueError):
        duration_us("10")


def test_spike_rule_strict_greater_than():
    avg, ratio, spike, hist = spike_step([1], 5)
    assert (avg, ratio, spike) == (1.0, 5.0, False)
    avg, ratio, spike, _ = spike_step([1], 6)
    assert (avg, ratio, spike) == (1.0, 6.0, True)
    assert hist == [1, 5]


def test_spike_rule_without_history():
    avg, ratio, spike, hist = spike_step([], 100)
    assert (avg, ratio, spike, hist) == (0.0, 0.0, False, [100])


def test_spike_history_keeps_last_ten():
    hist = []
    for n in range(1, 13):
        _, _, _, hist = spike_step(hist, n)
    assert hist == list(range(3, 13))
    avg, _, _, _ = spike_step(hist, 1)
    assert avg == sum(range(3, 13)) / 10


def test_editor_step_out_of_order_keeps_last():
    total, last = editor_step(0, 0, [5_000, 1_000])
    assert (total, last) == (2, 5_000)
    total, last = editor_step(total, last, [2_000])
    assert (total, last) == (3, 5_000)


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [([1, 2, 3], 4, 2.0, "  ", 2.675), (None, 7, 0.0, None, 1.005), ([5] * 10, 9, None, "x", 0.125)],
        "h array<long>, n long, avg double, s string, r double")
    out = df.select(
        push_history(F.col("h"), F.col("n"), 10).alias("ph"),
        history_mean(F.coalesce(F.col("h"), F.array().cast("array<long>"))).alias("hm"),
        guarded_ratio(F.col("n"), F.col("avg")).alias("gr"),
        is_blank(F.col("s")).alias("blank"),
        round2(F.col("r")).alias("r2"),
    ).collect()
    assert out[0].ph == [1, 2, 3, 4] and out[0].hm == 2.0 and out[0].gr == 2.0 and out[0].blank
    assert out[1].ph == [7] and out[1].hm == 0.0 and out[1].gr == 0.0 and out[1].blank
    assert out[2].ph == [5] * 9 + [9] and out[2].gr == 0.0 and not out[2].blank
    assert [r.r2 for r in out] == [2.68, 1.01, 0.13]  # HALF_UP on the decimal text


def _scalar_spans(times, total, last, span, idle):
    closed = []
    for t in times:
        if last is not None and t - last >= idle:
            closed.append((total, last, span))
            total, last, span = 0, None, None
        total += 1
        last = t if last is None else max(last, t)
        span = t if span is None else span
    return closed, (total, last, span)


def test_split_spans_matches_scalar_scan():
    import random

    import numpy as np

    from tidewatch.streaming.processors import split_spans

    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 30)
        times = sorted(rng.choice([0, 10, 3_599_999, 3_600_000, 3_600_001, 9_000_000]) * k // 3 + rng.randint(0, 5)
                       for k in range(n))
        state = rng.choice([(0, None, None), (4, times[0] - rng.choice([1, 3_600_000, 7_200_000]), 0),
                            (2, times[-1] + 5, 0)])
        got = split_spans(np.array(times, dtype="int64"), *state, 3_600_000)
        assert got == _scalar_spans(times, *state, 3_600_000), (times, state)
