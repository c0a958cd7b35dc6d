"""Published queries (Q1-Q5) on hand-made result tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import active_board, hourly_heatmap, spike_board, table_stats, top_trending
from tidewatch.operators import latest_per_key

T0 = dt.datetime(2024, 1, 1, 12, 0)


def _trending(spark):
    rows = []
    for k in range(40):  # 40 sliding windows of title A, one edit each
        ws = T0 + dt.timedelta(seconds=30 * k)
        rows.append((ws, ws + dt.timedelta(minutes=10), "A", "s1", 1))
    rows.append((T0 - dt.timedelta(hours=2), T0 - dt.timedelta(hours=2) + dt.timedelta(minutes=10), "B", "s1", 50))
    rows.append((T0, T0 + dt.timedelta(minutes=10), "C", "s2", 3))
    return spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, article_title string, "
                                       "server_name string, edit_count long")


def test_top_trending_last_hour_and_modes(spark):
    tr = _trending(spark)
    as_of = T0 + dt.timedelta(minutes=30)
    got = [tuple(r) for r in top_trending(tr, as_of=as_of).collect()]
    assert got == [("A", "s1", 40), ("C", "s2", 3)]  # B is older than an hour
    aligned = [tuple(r) for r in top_trending(tr, as_of=as_of, mode="distinct_edits").collect()]
    assert aligned == [("C", "s2", 3), ("A", "s1", 2)]  # only windows at :00 and :10
    assert top_trending(tr, as_of=as_of, limit=1).count() == 1


def test_active_board_uses_latest_snapshot(spark):
    log = spark.createDataFrame([
        ("u1", 5, T0, False, 0), ("u1", 5, T0, True, 3),  # expired later: must not show
        ("u2", 2, T0, False, 1), ("u2", 4, T0, False, 2),
        ("u3", 9, T0, False, 2),
    ], "user string, total_edits long, last_activity timestamp, is_expired boolean, batch_id int")
    assert [tuple(r)[:2] for r in active_board(log).collect()] == [("u3", 9), ("u2", 4)]
    raw = [tuple(r)[:2] for r in active_board(log, latest=False).collect()]
    assert raw == [("u3", 9), ("u1", 5), ("u2", 4), ("u2", 2)]


def test_spike_board_orders_recent_first_and_rounds(spark):
    df = spark.createDataFrame([
        ("A", T0, T0, 10, 3.0, 10 / 3, True), ("B", T0 + dt.timedelta(minutes=1), T0, 7, 1.0, 7.0, True),
        ("C", T0 + dt.timedelta(minutes=2), T0, 1, 1.0, 1.0, False),
    ], "article_title string, window_start timestamp, window_end timestamp, current_edit_count long, "
       "historical_average double, spike_multiplier double, is_spike boolean")
    got = [(r.article_title, r.spike_ratio) for r in spike_board(df).collect()]
    assert got == [("B", 7.0), ("A", 3.33)]


def test_hourly_heatmap(spark):
    got = [(r.hour_bucket, r.server_name, r.total_edits) for r in hourly_heatmap(_trending(spark)).collect()]
    assert got[0] == (T0, "s1", 40) and got[1] == (T0, "s2", 3)
    assert got[2] == (T0 - dt.timedelta(hours=2), "s1", 50)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 1, "z")], "k string, v int, p string")
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], ["v"]).collect()) == [("j", 1, "z"), ("k", 3, "c")]


def test_table_stats(spark, scratch):
    spark.range(100).repartition(3).write.parquet(f"{scratch}/t1")
    spark.range(10).coalesce(1).write.parquet(f"{scratch}/t2")
    got = {r.table_name: (r.file_count, r.total_bytes) for r in
           table_stats(spark, {"t1": f"{scratch}/t1", "t2": f"{scratch}/t2"}).collect()}
    assert got["t1"][0] == 3 and got["t2"][0] == 1 and got["t1"][1] > 0


def test_top_trending_from_events_equals_full_table(spark):
    from pyspark.sql import functions as F

    from data_dirs import SF01
    from tidewatch.operators import trending
    from tidewatch.plans import top_trending_from_events
    from tidewatch.plans.registry import _edits

    e = _edits(spark, SF01)
    full = trending(e)
    for as_of, lookback, mode in [("2024-01-15 12:00:00", "1 hour", "window_sum"),
                                  ("2024-01-20 00:00:00", "6 hours", "window_sum"),
                                  ("2024-01-10 07:13:00", "1 day", "distinct_edits")]:
        a = top_trending(full, as_of=as_of, lookback=lookback, mode=mode, limit=50).collect()
        b = top_trending_from_events(e, as_of=as_of, lookback=lookback, mode=mode, limit=50).collect()
        assert a == b and len(a) > 0


def test_hourly_heatmap_from_events_equals_expanded(spark):
    from data_dirs import SF01
    from tidewatch.config import DEFAULTS
    from tidewatch.operators import trending
    from tidewatch.plans import hourly_heatmap_from_events
    from tidewatch.plans.registry import _edits

    e = _edits(spark, SF01)
    for params in (DEFAULTS, DEFAULTS.with_(trending_window="20 minutes", trending_slide="1 minute"),
                   DEFAULTS.with_(trending_window="2 hours", trending_slide="10 minutes")):
        a = hourly_heatmap(trending(e, params)).collect()
        b = hourly_heatmap_from_events(e, params).collect()
        assert a == b and len(a) > 0


def test_latest_snapshot_across_two_runs(spark):
    """A second run starts its batch ids at 0 again: commit time decides, and batch reads name a run."""
    from tidewatch.sources import as_of
    log = spark.createDataFrame([
        ("a", 9, "r1", 7, "2024-01-01 00:00:00", False), ("a", 2, "r2", 0, "2024-01-02 00:00:00", False),
    ], "user string, total_edits long, run_id string, batch_id int, committed_at string, is_expired boolean").selectExpr(
        "*", "timestamp'2024-01-01' AS last_activity").withColumn("committed_at", F.col("committed_at").cast("timestamp"))
    assert active_board(log).first().total_edits == 2
    with pytest.raises(ValueError):
        as_of(log, batch_id=7)
    assert as_of(log, batch_id=7, run_id="r1").count() == 1


def test_cutoff_is_pushed_to_a_stored_table(spark, scratch):
    spark.createDataFrame([("t", "s", 3, "2024-01-01 00:00:00")], "article_title string, server_name string, edit_count long, w string").selectExpr(
        "article_title", "server_name", "edit_count", "timestamp(w) AS window_start").write.parquet(scratch)
    plan = top_trending(spark.read.parquet(scratch), as_of="2024-01-01 00:30:00")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(window_start" in plan


def test_table_stats_equal_the_folder_listing(spark, scratch):
    import glob
    import os

    from tidewatch.session import local_path
    spark.range(9).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(f"{scratch}/a")
    spark.range(0).write.parquet(f"{scratch}/b")
    got = {r.table_name: (r.file_count, r.total_bytes) for r in table_stats(spark, {"a": f"{scratch}/a", "b": f"{scratch}/b"}).collect()}
    for name, (n, size) in got.items():
        files = glob.glob(f"{local_path(scratch)}/{name}/**/*.parquet", recursive=True)
        assert (n, size) == (len(files), sum(map(os.path.getsize, files)))
