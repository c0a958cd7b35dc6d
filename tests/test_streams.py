"""Streaming jobs on ordered file streams (FIXTURES section 5) and their sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS
from tidewatch.session import local_path
from tidewatch.sources import from_json_files
from tidewatch.streaming.app import await_all
from tidewatch.streaming.jobs import start_editors, start_spikes, start_trending
from tidewatch.streaming.sinks import idempotent_batch_writer

BASE = 1709827200  # 2024-03-07 16:00:00 UTC
NOW = {"availableNow": True}


def ev(offset, user, title, type_="edit", i=[0]):
    i[0] += 1
    return json.dumps({"id": i[0], "title": title, "user": user, "timestamp": BASE + offset, "type": type_,
                       "server_name": "s"})


def write_batches(folder, batches):
    """One file per micro-batch, modification times strictly increasing."""
    d = local_path(folder)
    os.makedirs(d, exist_ok=True)
    for n, lines in enumerate(batches):
        p = os.path.join(d, f"batch-{n:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))
    return folder


STREAM_A = [
    [ev(0, "a", "P"), ev(5, "a", "P"), ev(10, "b", "Q"), "garbage", ev(10, "b", "Q", "log")],
    [ev(70, "a", "P")] + [ev(125, "b", "P") for _ in range(8)],
    [ev(2000, "c", "R")],
    [ev(1, "a", "P")],
    [ev(6000, "c", "R")],
    [ev(6001, "c", "R")],
]


@pytest.fixture(scope="module")
def stream_a(spark):
    from tidewatch.session import scratch_path

    return write_batches(scratch_path(spark, "stream-a") + "/input", STREAM_A)


def _rows_by_batch(spark, table, cols):
    out = {}
    for r in spark.read.parquet(table).collect():
        out.setdefault(r.batch_id, set()).add(tuple(r[c] for c in cols))
    return out


@pytest.mark.parametrize("api", ["rows", "frames"])
def test_editors_golden_stream(spark, stream_a, scratch, api):
    q = start_editors(from_json_files(spark, stream_a), f"{scratch}/t", f"{scratch}/c", trigger=NOW, api=api)
    await_all([q])
    got = {}
    for r in spark.read.parquet(f"{scratch}/t").collect():
        got.setdefault(r.batch_id, set()).add(
            (r.user, r.total_edits, int(r.last_activity.timestamp()) - BASE, r.is_expired))
    assert got == {
        0: {("a", 2, 5, False), ("b", 1, 10, False)},
        1: {("a", 3, 70, False), ("b", 9, 125, False)},
        2: {("c", 1, 2000, False)},
        3: {("a", 4, 70, False)},  # late row still counted: the late filter lags one batch
        4: {("c", 2, 6000, False)},
        5: {("a", 4, 70, True), ("b", 9, 125, True), ("c", 3, 6001, False)},
    }


@pytest.mark.parametrize("api", ["rows", "frames"])
def test_spikes_golden_stream_final_mode(spark, stream_a, scratch, api):
    q = start_spikes(from_json_files(spark, stream_a), f"{scratch}/t", f"{scratch}/c", trigger=NOW,
                     expiry="event_time", ttl="3650 days", api=api)
    await_all([q])
    got = {}
    for r in spark.read.parquet(f"{scratch}/t").collect():
        minute = (int(r.window_start.timestamp()) - BASE) // 60
        got.setdefault(r.batch_id, set()).add((r.article_title, minute, r.current_edit_count,
                                               r.historical_average, r.is_spike))
    assert got == {
        3: {("P", 0, 3, 0.0, False), ("P", 1, 1, 3.0, False), ("P", 2, 8, 2.0, False), ("Q", 0, 1, 0.0, False)},
        5: {("R", 33, 1, 0.0, False)},
    }


@pytest.mark.parametrize("api", ["rows", "frames"])
def test_spike_expiry_emits_sentinel(spark, stream_a, scratch, api):
    q = start_spikes(from_json_files(spark, stream_a), f"{scratch}/t", f"{scratch}/c", trigger=NOW,
                     expiry="event_time", ttl="1 minute", api=api)
    await_all([q])
    rows = spark.read.parquet(f"{scratch}/t").where(F.unix_millis("window_start") == 0).collect()
    assert rows and all(r.current_edit_count == 0 and not r.is_spike and r.historical_average == 0.0 for r in rows)
    assert {r.article_title for r in rows} >= {"P", "Q"}


@pytest.mark.parametrize("api", ["rows", "frames"])
def test_spike_live_mode_keeps_latest_window_per_batch(spark, stream_a, scratch, api):
    q = start_spikes(from_json_files(spark, stream_a), f"{scratch}/t", f"{scratch}/c", trigger=NOW,
                     mode="live", expiry="event_time", ttl="3650 days", api=api)
    await_all([q])
    spark.conf.set("spark.sql.streaming.statefulOperator.checkCorrectness.enabled", "true")
    got = _rows_by_batch(spark, f"{scratch}/t", ["article_title", "current_edit_count"])
    assert got[1] == {("P", 8)}  # minute 1 and 2 both updated; only the latest is scored
    assert got[0] == {("P", 2), ("Q", 1)}


def test_sliding_windows_late_rows(spark, scratch):
    batches = [
        [ev(0, "a", "P"), ev(1, "a", "P")], [ev(1205, "b", "Q")], [ev(1210, "b", "Q")],
        [ev(590, "late", "L10"), ev(599, "late", "L10"), ev(250, "late", "LX")],
        [ev(9000, "z", "F")], [ev(9001, "z", "F")],
    ]
    src = write_batches(f"{scratch}/input", batches)
    params = DEFAULTS.with_(trending_slide="5 minutes")
    q = start_trending(from_json_files(spark, src, params), f"{scratch}/t", f"{scratch}/c", params, trigger=NOW)
    await_all([q])
    got = {((int(r.window_start.timestamp()) - BASE) // 60, r.article_title, r.edit_count)
           for r in spark.read.parquet(f"{scratch}/t").collect()}
    assert got == {(-5, "P", 2), (0, "P", 2), (5, "L10", 2), (15, "Q", 2), (20, "Q", 2)}


def test_idempotent_sink_replay(spark, scratch):
    write = idempotent_batch_writer(f"{scratch}/t")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    write(df, 0)
    write(df, 1)
    write(df, 1)  # replay of batch 1 after a failure
    write(df.limit(0), 2)  # empty batch writes nothing
    t = spark.read.parquet(f"{scratch}/t")
    assert t.count() == 10
    assert sorted(r.batch_id for r in t.select("batch_id").distinct().collect()) == [0, 1]


def test_restart_from_checkpoint_equals_single_run(spark, scratch):
    """Stop after three files, add the rest, resume: same rows as one run.

    In-order input only -- with late rows the outcome legitimately depends on
    where Spark places its no-data batches (the late filter lags one batch)."""
    in_order = [b for n, b in enumerate(STREAM_A) if n != 3]

    def rows(table):
        return {(r.user, r.total_edits, r.last_activity, r.is_expired) for r in spark.read.parquet(table).collect()}

    whole = write_batches(f"{scratch}/whole", in_order)
    await_all([start_editors(from_json_files(spark, whole), f"{scratch}/t1", f"{scratch}/c1", trigger=NOW)])

    part = write_batches(f"{scratch}/part", in_order[:3])
    await_all([start_editors(from_json_files(spark, part), f"{scratch}/t2", f"{scratch}/c2", trigger=NOW)])
    d = local_path(part)
    for n, lines in enumerate(in_order[3:], start=3):
        p = os.path.join(d, f"batch-{n:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))
    await_all([start_editors(from_json_files(spark, part), f"{scratch}/t2", f"{scratch}/c2", trigger=NOW)])

    assert rows(f"{scratch}/t2") == rows(f"{scratch}/t1")
    # the resumed run keeps the query id stored in the checkpoint
    assert spark.read.parquet(f"{scratch}/t2").select("run_id").distinct().count() == 1
