"""Repeated events, chained windows, sessions, late rows, tables by date, files of a batch."""

import pytest
from pyspark.sql import functions as F

from test_streams import BASE, NOW, STREAM_A, ev, write_batches
from tidewatch.plans import hourly_heatmap, top_trending
from tidewatch.plans.serve import table_stats
from tidewatch.sources import deduplicated, from_json_files, watermarked
from tidewatch.streaming.app import await_all
from tidewatch.streaming.jobs import start_editors, start_sessions, start_spikes, start_trending
from tidewatch.streaming.late import late_rows_writer, start_late
from tidewatch.streaming.sinks import idempotent_batch_writer

IN_ORDER = [b for n, b in enumerate(STREAM_A) if n != 3]
COLUMNS = {start_trending: ["window_start", "article_title", "edit_count"], start_editors: ["user", "total_edits", "last_activity", "is_expired"],
           start_spikes: ["article_title", "window_start", "current_edit_count", "is_spike"]}


def table(spark, path, cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


@pytest.mark.parametrize("start", list(COLUMNS), ids=["trending", "editors", "spikes"])
def test_a_feed_that_repeats_itself_counts_once(spark, scratch, start):
    kw = {"expiry": "event_time", "ttl": "3650 days"} if start is start_spikes else {}
    once = from_json_files(spark, write_batches(f"{scratch}/once", IN_ORDER), watermark=False)
    twice = from_json_files(spark, write_batches(f"{scratch}/twice", [b + b for b in IN_ORDER]), watermark=False)
    q = [start(watermarked(once), f"{scratch}/t1", f"{scratch}/c1", trigger=NOW, query_name="once", **kw),
         start(deduplicated(watermarked(twice)), f"{scratch}/t2", f"{scratch}/c2", trigger=NOW, query_name="twice", **kw)]
    await_all(q)
    cols = COLUMNS[start]
    assert table(spark, f"{scratch}/t2", cols) == table(spark, f"{scratch}/t1", cols) != []
    ops = q[1].lastProgress["stateOperators"]
    ids = next(o for o in ops if "edup" in o["operatorName"])
    assert ids["numRowsTotal"] <= 3  # keys behind the watermark are forgotten


def test_chained_windows_equal_direct_ones_and_keep_less_state(spark, scratch):
    src = from_json_files(spark, write_batches(f"{scratch}/in", IN_ORDER), watermark=False)
    peak = {}
    for method in ("direct", "chained"):
        q = start_trending(src, f"{scratch}/{method}", f"{scratch}/c-{method}", trigger=NOW, method=method, query_name=method)
        await_all([q])
        peak[method] = max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress)
    cols = ["window_start", "window_end", "article_title", "server_name", "edit_count"]
    assert table(spark, f"{scratch}/chained", cols) == table(spark, f"{scratch}/direct", cols) != []
    assert 3 * peak["chained"] < peak["direct"]


def test_sessions_equal_the_strict_editor_job(spark, scratch):
    batches = [*IN_ORDER, [ev(20_000, "z", "F")], [ev(20_001, "z", "F")]]
    src = from_json_files(spark, write_batches(f"{scratch}/in", batches), watermark=False)
    await_all([start_sessions(src, f"{scratch}/s", f"{scratch}/cs", trigger=NOW),
               start_editors(src, f"{scratch}/e", f"{scratch}/ce", trigger=NOW, strict_gap=True)])
    cols = ["user", "span_start", "total_edits", "last_activity"]
    closed = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/e").where("is_expired").select(*cols).collect())
    assert table(spark, f"{scratch}/s", cols) == closed != []
    assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition") == "false"


def test_late_rows_are_those_the_jobs_drop(spark, scratch):
    batches = [[ev(0, "a", "P")], [ev(5000, "b", "Q")], [ev(1, "kept", "P")], [ev(2, "late", "P"), ev(5001, "b", "Q")], [ev(4400, "late", "P")],
               [ev(4402, "kept", "P")], [ev(9000, "z", "F")], [ev(9001, "z", "F")]]
    src = from_json_files(spark, write_batches(f"{scratch}/in", batches), watermark=False)
    q = start_editors(src, f"{scratch}/t", f"{scratch}/c", trigger=NOW)
    await_all([start_late(src, f"{scratch}/l", f"{scratch}/cl", trigger=NOW), q])
    late = spark.read.parquet(f"{scratch}/l/late").select("user", "batch_id").collect()
    assert sorted(tuple(r) for r in late) == [("late", 3), ("late", 4)]
    assert {r.user for r in spark.read.parquet(f"{scratch}/t").select("user").collect()} == {"a", "b", "kept", "z"}
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 2


def test_a_repeated_late_batch_changes_nothing(spark, scratch):
    write = late_rows_writer(scratch)
    rows = [spark.createDataFrame([(t,)], "t long").select(F.timestamp_seconds("t").alias("event_time")) for t in (100_000, 100_010, 99_400, 5, 7)]
    for n, df in enumerate(rows):
        write(df, n)
        write(df, n)
    got = sorted((int(r.event_time.timestamp()), r.batch_id) for r in spark.read.parquet(f"{scratch}/late").collect())
    assert got == [(5, 3), (7, 4), (99_400, 2)]


def test_tables_by_date_are_pruned(spark, scratch):
    day = 86_400
    batches = [[ev(k * day + m * 60, "a", f"P{m % 3}") for m in range(30)] for k in range(4)] + [[ev(9 * day, "z", "F")], [ev(9 * day + 1, "z", "F")]]
    src = from_json_files(spark, write_batches(f"{scratch}/in", batches), watermark=False)
    await_all([start_trending(src, f"{scratch}/t", f"{scratch}/c", trigger=NOW, method="chained", by_date=True)])
    t = spark.read.parquet(f"{scratch}/t")
    dates = [r.date for r in t.select("date").distinct().orderBy("date").collect()]
    assert len(dates) == 4 and t.where("date <> to_date(window_start)").count() == 0
    import datetime as dt
    newest = dt.datetime.fromtimestamp(BASE + 3 * day + 1800)
    q1, q4 = top_trending(t, as_of=newest), hourly_heatmap(t, since=newest - dt.timedelta(hours=1))
    for q, plain in ((q1, top_trending(t.drop("date"), as_of=newest)), (q4, hourly_heatmap(t.drop("date"), since=newest - dt.timedelta(hours=1)))):
        assert "PartitionFilters: [isnotnull(date" in q._jdf.queryExecution().executedPlan().toString()
        assert q.collect() == plain.collect() != []


def test_a_batch_writes_files_of_a_stated_size(spark, scratch):
    write = idempotent_batch_writer(f"{scratch}/t", rows_per_file=400)
    df = spark.range(1000, numPartitions=8)
    write(df, 0)
    write(df.limit(5).repartition(8), 1)
    got = table_stats(spark, {"a": f"{scratch}/t/run_id=adhoc/batch_id=0", "b": f"{scratch}/t/run_id=adhoc/batch_id=1"}).collect()
    assert [(r.table_name, r.file_count) for r in got] == [("a", 3), ("b", 1)]
    assert spark.read.parquet(f"{scratch}/t").count() == 1005
