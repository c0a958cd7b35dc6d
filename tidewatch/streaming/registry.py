"""Stream-backed named queries.

Each replays the whole ChangeEvent view of ``events`` as ordered JSON files
(one micro-batch per day), drains it with ``availableNow`` through the real
streaming job and returns the table the job wrote.  Folders live under the
session's shared checkpoint root.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewatch.functions.columns import to_ntz
from tidewatch.operators import editor_spans, latest_per_key, spikes, trending
from tidewatch.plans.registry import WIDE_SPIKES, _edits
from tidewatch.plans.serve import active_board, hourly_heatmap, table_stats, top_trending
from tidewatch.session import drained_stream_settings, ensure_utc, scratch_path, shared_root
from tidewatch.sources import as_of, change_events, deduplicated, from_json_files, read_result, register_result, watermarked
from tidewatch.streaming.app import await_all
from tidewatch.streaming.current import read_current
from tidewatch.streaming.jobs import start_editors, start_sessions, start_spikes, start_trending
from tidewatch.streaming.late import start_late
from tidewatch.streaming.replay import FLUSH, replay_input

AVAILABLE_NOW = {"availableNow": True}
PERIOD = "1 day"
REPLAY_VERSION = "v3"  # bump when the replay layout changes
STATE_PARTITIONS = 8   # shuffle width of the replayed queries' state at least
STATE_BYTES = 64 << 20  # of the events' files, for one state partition more
BUCKETS_PER_PARTITION = 4  # of the editor state
RUN_STATS: dict[str, dict] = {}  # name -> progress summary of its last drained run

# The replay drains a month of events in about a minute of wall clock, so under
# the defined 30-minute processing-time expiry no title expires during the run.
# A processing-time timer also keeps ``availableNow`` from finishing (Spark keeps
# scheduling no-data batches for it), so the drained run uses event-time expiry
# with a horizon longer than the data, which expires nothing either.
REPLAY_SPIKE_TTL = "36500 days"
SHORT_TTL = "12 hours"  # of the key that shows expiry; shorter than the replay, so titles do expire
SPIKE_COLUMNS = ("article_title", "window_start", "window_end", "current_edit_count", "historical_average",
                 "spike_multiplier", "is_spike")


def _files(spark: SparkSession, sf_dir: str) -> list:
    """Names, sizes and times of the files behind ``events``: changed data, another replay."""
    return (spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/events.parquet")
            .select("path", "length", "modificationTime").orderBy("path").collect())


def _width(spark: SparkSession, sf_dir: str) -> int:
    """State partitions of a replay: a task per core at least, more as the events' files grow."""
    return max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism, sum(r.length for r in _files(spark, sf_dir)) // STATE_BYTES)


def _delay():
    """Days by which a change arrives late in the replays out of order: one in twenty, one to three."""
    return F.when(F.col("id") % 20 == 0, 1 + F.floor(F.col("id") / 20) % 3).otherwise(0)


def _input(spark: SparkSession, sf_dir: str, period: str = PERIOD, kind: str = "in order") -> str:
    """The replay's folder.  Kinds: in order, out of order, twice (every change is delivered
    twice), open (no flush rows, so the last keys stay open)."""
    ensure_utc(spark)
    files = "|".join(f"{r.path}:{r.length}:{r.modificationTime}" for r in _files(spark, sf_dir))
    tag = hashlib.sha1(f"{files}|{period}|{kind}|{REPLAY_VERSION}".encode()).hexdigest()[:12]
    changes = change_events(spark, sf_dir)
    options = {}
    if kind == "twice":
        changes = changes.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    elif kind == "out of order":
        options["delay"] = _delay()
    elif kind == "open":
        options["flush"] = False
    return replay_input(spark, changes, f"{shared_root(spark)}/replay-{tag}", period, **options)


class _Progress(StreamingQueryListener):
    """All progress reports of one query; ``recentProgress`` forgets the older ones."""

    def __init__(self, enough_after: int | None = None):
        self.reports: list[dict] = []
        self.ended = threading.Event()
        self.enough, self.enough_after = threading.Event(), enough_after
        self.query = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.reports.append(json.loads(event.progress.json))
        if len(self.reports) == self.enough_after:
            self.enough.set()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self.query is None or str(event.id) == self.query:
            self.ended.set()
            self.enough.set()


def _run(spark, sf_dir, name, starter, period: str = PERIOD, kind: str = "in order", prepare=None, stop_after: int | None = None,
         **kw) -> str:
    """Drain a replay through a job; returns the folder with its ``table`` and ``checkpoint``.

    ``prepare`` maps the stream before the job.  With ``stop_after`` the query is stopped
    after so many micro-batches, wherever it is then, and started again from its checkpoint.
    """
    src = from_json_files(spark, _input(spark, sf_dir, period, kind), watermark=False)
    src = prepare(src) if prepare else src
    root = scratch_path(spark, name)
    seen = _Progress(stop_after)
    spark.streams.addListener(seen)
    width = _width(spark, sf_dir)
    if starter is start_editors:
        kw["buckets"] = BUCKETS_PER_PARTITION * width

    def start():
        q = starter(src, f"{root}/table", f"{root}/checkpoint", trigger=AVAILABLE_NOW, **kw)
        seen.query = str(q.id)
        return q

    try:
        with drained_stream_settings(spark, width):
            t0 = time.perf_counter()
            if stop_after:
                q = start()
                seen.enough.wait(600)
                q.stop()
                seen.ended.clear()
            await_all([start()])
            wall = time.perf_counter() - t0
        seen.ended.wait(10)
    finally:
        spark.streams.removeListener(seen)
    RUN_STATS[name] = progress_summary([r for r in seen.reports if r["id"] == seen.query], wall)
    return root


def _without_flush(df: DataFrame, spark: SparkSession, sf_dir: str, key: str, time_col: str) -> DataFrame:
    """Remove the flush rows, a day past the newest change; null keys and real rows of that name stay."""
    newest = change_events(spark, sf_dir).select(F.max("event_time")).scalar()
    return df.where(~(F.col(key).eqNullSafe(FLUSH) & (F.col(time_col) > newest)))


def progress_summary(progress: list, wall_sec: float) -> dict:
    """Drain time, input rows/s, final state rows and late-dropped rows of a run."""
    rows = sum(p.get("numInputRows", 0) for p in progress)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))
    last_ops = progress[-1].get("stateOperators", []) if progress else []
    return {
        "batches": len(progress),
        "input_rows": rows,
        "drain_sec": round(wall_sec, 3),
        "rows_per_sec": round(rows / wall_sec, 1) if wall_sec > 0 else None,
        "state_rows_end": sum(op.get("numRowsTotal", 0) for op in last_ops),
        "state_rows_peak": max((sum(op.get("numRowsTotal", 0) for op in p.get("stateOperators", []))
                                for p in progress), default=0),
        "rows_dropped_late": dropped,
    }


def q_trending_stream(spark, sf_dir, period: str = PERIOD):
    return _trending_of(spark, sf_dir, _run(spark, sf_dir, "trending_stream", start_trending, period))


def _trending_of(spark, sf_dir, root: str) -> DataFrame:
    # a window that holds a flush row ends a day past the newest change
    return to_ntz(_without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "article_title", "window_end"))


def q_trending_chained(spark, sf_dir):
    """The trending job as two aggregates in a row, counts per slide and sums per window."""
    return _trending_of(spark, sf_dir, _run(spark, sf_dir, "trending_chained", start_trending, method="chained"))


def q_trending_dedup(spark, sf_dir):
    """The trending job behind the removal of repeated events, on a feed that delivers each event twice.

    The feed is in order, so no edit is late and the chained form counts what the direct one would."""
    root = _run(spark, sf_dir, "trending_dedup", start_trending, kind="twice", prepare=lambda s: deduplicated(watermarked(s)),
                method="chained")
    return _trending_of(spark, sf_dir, root)


def q_trending_late(spark, sf_dir):
    """The trending job on a feed out of order: what an edit behind the watermark still counts in."""
    return _trending_of(spark, sf_dir, _run(spark, sf_dir, "trending_late", start_trending, kind="out of order"))


def q_late_rows(spark, sf_dir):
    """The edits of the feed out of order that are behind the watermark when they arrive, with their micro-batch."""
    root = _run(spark, sf_dir, "late_rows", start_late, kind="out of order")
    return to_ntz(read_result(spark, f"{root}/table/late").select("id", "title", "user", "event_time", F.col("batch_id").cast("long").alias("batch_id")))


def q_editors_sessions(spark, sf_dir):
    """The editor job as session windows: every activity span once it is over."""
    root = _run(spark, sf_dir, "editors_sessions", start_sessions)
    return to_ntz(_without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "user", "last_activity"))


def q_editors_restart(spark, sf_dir):
    """The editors' open spans, read from the state of a job that was stopped on the way and started again."""
    root = _run(spark, sf_dir, "editors_restart", start_editors, kind="open", stop_after=7, strict_gap=True)
    state = spark.read.format("statestore").option("path", f"{root}/checkpoint").option("stateVarName", "editor").load()
    spans = state.selectExpr("inline(arrays_zip(value.user, value.total, value.last_ms, value.span_ms)) AS (user, total, last_ms, span_ms)")
    return to_ntz(spans.select("user", F.timestamp_millis("span_ms").alias("span_start"), F.col("total").alias("total_edits"),
                               F.timestamp_millis("last_ms").alias("last_activity")))


def _editors_log(spark, sf_dir, name: str, strict_gap: bool = True, period: str = PERIOD) -> DataFrame:
    """The editor update log of one drained replay."""
    root = _run(spark, sf_dir, name, start_editors, period, strict_gap=strict_gap)
    return _without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "user", "last_activity")


def q_editors_stream(spark, sf_dir, period: str = PERIOD):
    """Final row of every activity span in the update log."""
    log = _editors_log(spark, sf_dir, "editors_stream", period=period)
    final = latest_per_key(log.drop("run_id", "committed_at"), ["user", "span_start"],
                           ["batch_id", "is_expired", "total_edits"])
    return to_ntz(final.select("user", "span_start", "total_edits", "last_activity", "is_expired"))


def q_as_of_snapshot(spark, sf_dir):
    """S5 + W4: each editor's newest span as the log stood after the middle day's batch.

    A batch logs the spans it closes and the open one of an editor, so the newest
    row of an editor is the one of the newest batch, span and, in it, the expired one.
    """
    log = _editors_log(spark, sf_dir, "as_of_snapshot")
    days = (log.where(~F.col("is_expired") | (F.col("last_activity") > F.col("span_start")))
            .groupBy("run_id", "batch_id").agg(F.max("last_activity").cast("date").alias("day")))
    open_days = log.where(~F.col("is_expired")).select(F.col("last_activity").cast("date").alias("day")).distinct()
    n = open_days.count()  # one row per day of the replay
    middle = open_days.orderBy("day").offset((n - 1) // 2).limit(1).scalar()
    upto = days.join(open_days, "day", "left_semi").where(F.col("day") <= middle)
    snap = as_of(log, batch_id=upto.select(F.max("batch_id")).scalar(), run_id=upto.select(F.max("run_id")).scalar())
    newest = latest_per_key(snap.drop("run_id", "committed_at"), ["user"], ["batch_id", "span_start", "is_expired", "total_edits"])
    return to_ntz(newest.select("user", "span_start", "total_edits", "last_activity", "is_expired"))


def q_editors_live(spark, sf_dir):
    """The defined editor behaviour (every edit of a batch joins the running total):
    the whole update log, one row per changed editor and micro-batch."""
    log = _editors_log(spark, sf_dir, "editors_live", strict_gap=False)
    return to_ntz(log.select("user", "total_edits", "last_activity", "is_expired"))


def q_spikes_live(spark, sf_dir):
    """The defined spike behaviour: partial counts of the latest window per title and
    micro-batch (update mode), one-minute windows, multiplier 5."""
    root = _run(spark, sf_dir, "spikes_live", start_spikes, mode="live", expiry="event_time",
                ttl=REPLAY_SPIKE_TTL)
    df = _without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "article_title", "window_end")
    return to_ntz(df.select(*SPIKE_COLUMNS))


def q_spikes_stream(spark, sf_dir, period: str = PERIOD):
    root = _run(spark, sf_dir, "spikes_stream", start_spikes, period, params=WIDE_SPIKES, expiry="event_time",
                ttl=REPLAY_SPIKE_TTL)
    df = _without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "article_title", "window_end")
    return to_ntz(df.select(*SPIKE_COLUMNS))


def q_spikes_expiring(spark, sf_dir):
    """T10/T11 in event time: a title without an edit for ``SHORT_TTL`` after its last window is
    forgotten and leaves a sentinel row; its history starts anew."""
    root = _run(spark, sf_dir, "spikes_expiring", start_spikes, params=WIDE_SPIKES, expiry="event_time", ttl=SHORT_TTL)
    df = read_result(spark, f"{root}/table")
    flushed = F.col("article_title").eqNullSafe(FLUSH)  # the flush rows' title, its windows and its sentinel
    return to_ntz(df.where(~flushed).select(*SPIKE_COLUMNS))


def q_top_trending_table(spark, sf_dir):
    """Q1 on the table that the trending job wrote, partitioned by date, of the day up to the newest window."""
    t = _dated_table(spark, sf_dir, "top_trending_table")
    return top_trending(t, as_of=t.select(F.max("window_start")).scalar(), lookback="1 day")


def q_heatmap_table(spark, sf_dir):
    """Q4 on the table that the trending job wrote, partitioned by date."""
    return to_ntz(hourly_heatmap(_dated_table(spark, sf_dir, "heatmap_table")))


def _dated_table(spark, sf_dir, name: str) -> DataFrame:
    root = _run(spark, sf_dir, name, start_trending, method="chained", by_date=True)
    return _without_flush(read_result(spark, f"{root}/table"), spark, sf_dir, "article_title", "window_end")


def q_active_board_table(spark, sf_dir):
    """Q2 on the editors' update log as the job left it, the flush rows not yet in: the latest row of
    each editor, if it is not an expired one."""
    root = _run(spark, sf_dir, "active_board_table", start_editors, kind="open", strict_gap=True)
    return to_ntz(active_board(read_result(spark, f"{root}/table"), version_cols=("batch_id", "span_start", "is_expired", "total_edits")))


def q_active_board_current(spark, sf_dir):
    """Q2 on the table of each editor's latest row that the job keeps, so no snapshot is looked for."""
    root = _run(spark, sf_dir, "active_board_current", start_editors, kind="open", strict_gap=True, current=_width(spark, sf_dir))
    return to_ntz(active_board(read_current(spark, f"{root}/table"), latest=False))


def q_spike_board_table(spark, sf_dir):
    """Q3 by SQL on the name under which the table that the spike job wrote is registered."""
    root = _run(spark, sf_dir, "spike_board_table", start_spikes, params=WIDE_SPIKES, expiry="event_time", ttl=REPLAY_SPIKE_TTL)
    register_result(spark, "edit_spikes", f"{root}/table")
    return to_ntz(spark.sql("""
        SELECT article_title, window_start, window_end, current_edit_count, historical_average,
               CAST(round(CAST(spike_multiplier AS DECIMAL(38, 12)), 2) AS DOUBLE) AS spike_ratio
        FROM edit_spikes WHERE is_spike ORDER BY window_start DESC, article_title LIMIT 20"""))


def q_table_stats(spark, sf_dir):
    """Q5 over the three result tables written from the batch operators."""
    e = _edits(spark, sf_dir)
    root = scratch_path(spark, "tables")
    paths = {"trending_articles": f"{root}/trending_articles", "active_editors": f"{root}/active_editors",
             "edit_spikes": f"{root}/edit_spikes"}
    trending(e).write.mode("overwrite").parquet(paths["trending_articles"])
    editor_spans(e).write.mode("overwrite").parquet(paths["active_editors"])
    spikes(e).write.mode("overwrite").parquet(paths["edit_spikes"])
    return table_stats(spark, paths)


STREAM_QUERIES = {
    "trending_stream": q_trending_stream,
    "editors_stream": q_editors_stream,
    "spikes_stream": q_spikes_stream,
    "as_of_snapshot": q_as_of_snapshot,
    "editors_live": q_editors_live,
    "spikes_live": q_spikes_live,
    "trending_chained": q_trending_chained,
    "trending_dedup": q_trending_dedup,
    "trending_late": q_trending_late,
    "late_rows": q_late_rows,
    "editors_sessions": q_editors_sessions,
    "editors_restart": q_editors_restart,
    "spikes_expiring": q_spikes_expiring,
    "top_trending_table": q_top_trending_table,
    "heatmap_table": q_heatmap_table,
    "active_board_table": q_active_board_table,
    "active_board_current": q_active_board_current,
    "spike_board_table": q_spike_board_table,
    "table_stats": q_table_stats,
}
