"""Editor activity (A5, A6, W2, W3): batch twin of the keyed editor state.

An editor's *activity span* is a maximal run of edits in which every gap to
the previous edit is shorter than ``editor_idle`` (1 hour); a gap of exactly
the idle time starts a new span.  Inside a span the running total counts edits
in (event_time, id) order and ``last_activity`` is the latest edit time.

Scale: a single editor (a bot) may own a third of all rows, so nothing here is
partitioned by ``user`` alone.  Rows are split into (user, time bucket) groups,
the bucket as wide as the idle gap unless ``bucket`` says otherwise:

1. one window pass over (user, bucket) ordered by time gives each row its
   in-bucket predecessor, row number and the last span start seen so far;
2. a per-(user, bucket) summary (one row per active editor-bucket) carries what
   crosses bucket borders: whether the bucket's first edit starts a span (its
   predecessor is the last edit of the previous non-empty bucket), the span open
   at the end of each bucket and running edit counts.  Only this summary is
   windowed by user, and it is bounded by the number of buckets in the time
   range, not by the editor's edit count;
3. one equi-join on (user, bucket) brings the carry back to the rows.

The result per row equals ``count(*) over (partition by user, span order by
event_time, id)`` without ever putting one editor's rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Params, duration_us


def _running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def editor_running(events: DataFrame, params: Params = DEFAULTS, time_col: str = "event_time",
                   id_col: str = "id", bucket: str | None = None) -> DataFrame:
    """W2/W3 per edit: user, id, event_time, span_start, total_edits, last_activity.

    ``bucket`` (default: the idle gap) is the time slice that splits an editor's
    rows; any width gives the same result, a finer one spreads a dense editor
    over more tasks at the price of a larger per-bucket summary.
    """
    gap = duration_us(params.editor_idle)
    width = duration_us(bucket) if bucket else gap
    t = F.unix_micros(F.col(time_col))
    # Both the row pass and the bucket summary read exactly these four columns, so
    # their shuffle on (user, bucket) is one exchange, reused by the second branch.
    base = events.where(F.col(time_col).isNotNull()).select(
        F.col("user"), F.col(id_col).alias("_id"), t.alias("_t"), F.floor(t / F.lit(width)).cast("long").alias("_b"),
    ).where(F.col("_b").isNotNull())  # as the join below would infer for one branch alone

    # 1. in-bucket pass: predecessor, row number, last in-bucket span start so far
    w_in = Window.partitionBy("user", "_b").orderBy("_t", "_id")
    e1 = base.select("*", F.row_number().over(w_in).alias("_rn"), F.lag("_t").over(w_in).alias("_prev"))
    inner = F.col("_prev").isNotNull() & ((F.col("_t") - F.col("_prev")) >= F.lit(gap))
    e1 = e1.select("*", F.when(inner, F.col("_t")).alias("_is_t"), F.when(inner, F.col("_rn")).alias("_is_rn"))
    e1 = e1.select(
        "user", "_id", "_t", "_b", "_rn", "_is_t", "_is_rn",
        F.max("_is_t").over(_running(w_in)).alias("_seg_t"),
        F.max("_is_rn").over(_running(w_in)).alias("_seg_rn"),
    )

    # 2. per-(user, bucket) summary and carries across buckets (small: one row per editor-bucket)
    s = e1.groupBy("user", "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"),
        F.max("_is_t").alias("_ils"), F.max("_is_rn").alias("_ilrn"),
    )
    w_u = Window.partitionBy("user").orderBy("_b")
    before = w_u.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*", F.lag("_b").over(w_u).alias("_pb"), F.lag("_last").over(w_u).alias("_pl"),
        F.sum("_n").over(_running(w_u)).alias("_C"),
    )
    # the predecessor of a bucket's first edit is the last edit of the editor's
    # previous non-empty bucket, however far back it lies
    first_start = F.col("_pb").isNull() | ((F.col("_first") - F.col("_pl")) >= F.lit(gap))
    cp = F.col("_C") - F.col("_n")  # edits of this editor in earlier buckets
    s = s.select("user", "_b", "_first", first_start.alias("_fs"), cp.alias("_Cp"),
                 F.coalesce(F.col("_ils"), F.when(first_start, F.col("_first"))).alias("_lsb"),
                 F.when(F.col("_ilrn").isNotNull(), cp + F.col("_ilrn") - 1)
                 .when(first_start, cp).alias("_K"))
    s = s.select(F.col("user").alias("_su"), F.col("_b").alias("_sb"), "_first", "_fs", "_Cp",
                 F.max("_lsb").over(before).alias("_carry_t"),
                 F.max("_K").over(before).alias("_carry_k"))

    # 3. bring the carries back to the rows (null-safe on user: null editors form one key)
    j = e1.join(s, on=[F.col("user").eqNullSafe(F.col("_su")), F.col("_b") == F.col("_sb")]).select(
        "user", "_id", "_t", "_rn", "_seg_t", "_seg_rn", "_first", "_fs", "_Cp", "_carry_t", "_carry_k",
    )
    seg0 = F.col("_seg_rn").isNull()
    span_start = F.when(seg0, F.when(F.col("_fs"), F.col("_first")).otherwise(F.col("_carry_t"))).otherwise(
        F.col("_seg_t"))
    local = F.col("_rn") - F.coalesce(F.col("_seg_rn"), F.lit(1)) + 1
    total = F.when(seg0 & ~F.col("_fs"), local + F.col("_Cp") - F.col("_carry_k")).otherwise(local)
    return j.select(
        F.col("user"),
        F.col("_id").alias(id_col),
        F.timestamp_micros("_t").alias("event_time"),
        F.timestamp_micros(span_start).alias("span_start"),
        total.cast("long").alias("total_edits"),
        F.timestamp_micros("_t").alias("last_activity"),
    )


def _merged_spans(events: DataFrame, params: Params, time_col: str, bucket: str | None) -> DataFrame:
    """Spans from segments: the runs of edits inside one (user, bucket) are reduced to
    a row each in the task that holds them, and only those rows meet per user."""
    gap = duration_us(params.editor_idle)
    width = duration_us(bucket) if bucket else gap
    t = F.unix_micros(F.col(time_col))
    rows = events.where(F.col(time_col).isNotNull()).select(
        F.col("user"), t.alias("_t"), F.floor(t / F.lit(width)).cast("long").alias("_b"))

    def runs(df: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(first)
        before = F.lag(last).over(w)
        new = before.isNull() | ((F.col(first) - before) >= F.lit(gap))
        return df.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(_running(w)))

    segments = (runs(rows, ["user", "_b"], "_t", "_t").groupBy("user", "_b", "_run")
                .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_n")))
    spans = (runs(segments.drop("_run"), ["user"], "_first", "_last").groupBy("user", "_run")
             .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("total_edits")))
    return spans.select("user", F.timestamp_micros("_first").alias("span_start"), "total_edits",
                        F.timestamp_micros("_last").alias("last_activity"))


def expired_flag(last_activity: Column, newest_event: Column, params: Params = DEFAULTS) -> Column:
    """A span is expired once the watermark (newest edit - delay) has passed last + idle."""
    return (F.unix_micros(last_activity) + F.lit(duration_us(params.editor_idle))) < (
        F.unix_micros(newest_event) - F.lit(duration_us(params.watermark_delay)))


def editor_spans(events: DataFrame, params: Params = DEFAULTS, time_col: str = "event_time",
                 id_col: str = "id", method: str = "bucketed", bucket: str | None = None) -> DataFrame:
    """active_editors as one row per activity span:
    user, span_start, total_edits, last_activity, is_expired.

    ``method='session_window'`` is Spark's built-in ``session_window`` with the idle
    gap.  Its plan combines map-side only rows with identical timestamps, then
    shuffles by ``user`` alone and sorts each editor's rows in one task before
    merging sessions -- fine without hot editors, but a bot with a third of all
    edits lands in a single task.  The default ``bucketed`` plan never does.
    """
    if method == "session_window":
        spans = (events.where(F.col(time_col).isNotNull())
                 .groupBy("user", F.session_window(time_col, params.editor_idle).alias("s"))
                 .agg(F.count(F.lit(1)).alias("total_edits"), F.max(time_col).alias("last_activity"))
                 .select("user", F.col("s.start").alias("span_start"), "total_edits", "last_activity"))
    elif method == "bucketed":
        spans = _merged_spans(events, params, time_col, bucket)
    else:
        raise ValueError(f"unknown method {method!r}")
    newest = events.select(F.max(time_col)).scalar()  # scalar subquery, one value
    return spans.select("user", "span_start", "total_edits", "last_activity",
                        expired_flag(F.col("last_activity"), newest, params).alias("is_expired"))


def editor_step(total: int, last_ms: int, batch_times_ms: list[int]) -> tuple[int, int]:
    """U1 update as a pure function: (total + n, max(last, batch max))."""
    new_last = last_ms
    for ms in batch_times_ms:
        if ms > new_last:
            new_last = ms
    return total + len(batch_times_ms), new_last
