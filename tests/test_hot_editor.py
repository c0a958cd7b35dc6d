"""Editors combined before the shuffle: one with a third of all edits, counts per task and second."""

import random

import pytest
from pyspark.sql import functions as F

from test_streams import BASE, NOW, ev, write_batches
from tidewatch.operators.partials import has_watermark, partial_counts
from tidewatch.sources import from_json_files
from tidewatch.streaming.app import await_all
from tidewatch.streaming.jobs import editors_frame, start_editors

RNG = random.Random(7)
TIMES = [[day * 7200 + RNG.randrange(3600) for _ in range(900)] for day in range(3)]
BATCHES = [[ev(t - t % 60 if i % 3 == 0 else t, "bot" if i % 3 == 0 else f"u{i % 40}", "P") for i, t in enumerate(sorted(ts))] for ts in TIMES]
BATCHES += [[ev(90_000, "z", "F")], [ev(90_001, "z", "F")]]


def spans(batches):
    """(user, span start, edits, last) by brute force."""
    import json
    times = {}
    for line in (x for b in batches for x in b):
        e = json.loads(line)
        times.setdefault(e["user"], []).append(e["timestamp"] - BASE)
    out = set()
    for user, ts in times.items():
        ts.sort()
        first, n, last = ts[0], 0, ts[0]
        for t in ts:
            if t - last >= 3600:
                out.add((user, first, n, last))
                first, n = t, 0
            n, last = n + 1, t
        out.add((user, first, n, last))
    return {s for s in out if s[0] != "z"}


@pytest.mark.parametrize("api", ["rows", "frames"])
def test_spans_with_a_hot_editor(spark, scratch, api):
    src = from_json_files(spark, write_batches(f"{scratch}/in", BATCHES), watermark=False)
    await_all([start_editors(src, f"{scratch}/t", f"{scratch}/c", trigger=NOW, strict_gap=True, api=api)])
    got = {(r.user, int(r.span_start.timestamp()) - BASE, r.total_edits, int(r.last_activity.timestamp()) - BASE)
           for r in spark.read.parquet(f"{scratch}/t").where("is_expired").collect()}
    assert got == spans(BATCHES)


def test_a_key_gets_a_row_per_task_and_second(spark):
    df = spark.range(60_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "bot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("user"),
        F.timestamp_seconds((F.col("id") / 6000).cast("long")).alias("event_time"), F.lit("x").alias("edits"))
    got = partial_counts(df, "user")
    assert got.where("user = 'bot'").count() <= 4 * 10
    same = got.groupBy("user", "event_time").agg(F.sum("edits").alias("n"))
    want = df.groupBy("user", "event_time").agg(F.count("*").alias("n"))
    assert same.exceptAll(want).isEmpty() and want.exceptAll(same).isEmpty()
    assert partial_counts(df.limit(0), "user").count() == 0


def test_combined_before_the_shuffle_by_user(spark, scratch):
    src = from_json_files(spark, write_batches(f"{scratch}/in", BATCHES[:1]), watermark=False)
    frame = editors_frame(src)
    plan = frame._jdf.queryExecution().analyzed().toString()
    state, combine = plan.index("TransformWithState"), plan.index("MapInArrow")
    assert state < combine and "EventTimeWatermark" in plan[state:combine]  # the watermark comes after the counts
    assert not has_watermark(src) and has_watermark(from_json_files(spark, f"{scratch}/in"))
