"""Queries that run on the wall clock: default trigger (T17), await (T14), processing-time expiry."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from data_dirs import SF001
from test_streams import STREAM_A, write_batches
from tidewatch.sources import change_events, from_json_files
from tidewatch.streaming import registry
from tidewatch.streaming.app import await_any
from tidewatch.streaming.jobs import start_spikes, start_trending
from tidewatch.streaming.replay import FLUSH


def until(condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def rows(spark, path, condition="true"):
    try:
        return spark.read.parquet(path).where(condition).collect()
    except AnalysisException as e:  # nothing is written yet
        assert e.getCondition() == "PATH_NOT_FOUND" or "infer schema" in str(e), e
        return []


def test_default_trigger_runs_on_and_await_any_returns_when_one_ends(spark, scratch):
    spark.streams.resetTerminated()
    q = start_trending(from_json_files(spark, write_batches(f"{scratch}/in", STREAM_A)), f"{scratch}/t", f"{scratch}/c")
    try:
        assert await_any(spark, timeout=1) is False
        assert until(lambda: rows(spark, f"{scratch}/t"))  # batches follow each other without a trigger
        assert q.isActive
    finally:
        q.stop()
    assert await_any(spark, timeout=30) is True
    spark.streams.resetTerminated()


def test_idle_titles_expire_by_the_wall_clock(spark, scratch):
    q = start_spikes(from_json_files(spark, write_batches(f"{scratch}/in", STREAM_A)), f"{scratch}/t", f"{scratch}/c", ttl="3 seconds")
    try:
        assert until(lambda: {r.article_title for r in rows(spark, f"{scratch}/t", "window_start = timestamp'1970-01-01'")} >= {"P", "Q"}, 150)
    finally:
        q.stop()
    for r in rows(spark, f"{scratch}/t", "window_start = timestamp'1970-01-01'"):
        assert (r.current_edit_count, r.historical_average, r.is_spike) == (0, 0.0, False)


def test_flush_rows_go_and_null_or_like_named_keys_stay(spark):
    newest = change_events(spark, SF001).agg(F.max("event_time")).first()[0]
    df = spark.createDataFrame([(None, newest), (FLUSH, newest), ("page", newest)], "title string, at timestamp")
    df = df.unionByName(df.where(f"title = '{FLUSH}'").withColumn("at", F.expr("at + INTERVAL 1 DAY")))
    left = registry._without_flush(df, spark, SF001, "title", "at")
    assert sorted(str(r.title) for r in left.collect()) == sorted(["None", FLUSH, "page"])
