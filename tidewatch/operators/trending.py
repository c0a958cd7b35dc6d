"""Edits per (sliding window, title, server_name).

Two plans with equal results:

* ``direct`` (streams): ``groupBy(window(ts, 10 min, 30 s), title, server_name)``.  Spark
  expands each row into its 20 windows, combines map-side (partial
  HashAggregate) and shuffles once on (window, title, server_name).
* ``prebucketed`` (batch, unless ``direct`` is asked for): count per (30 s bucket, title, server_name) first, then
  expand each *bucket* to its 20 windows and sum.  Counts are decomposable, so
  the 20x fan-out happens after the data has been reduced to one row per
  non-empty bucket.  Costs a second (much smaller) shuffle.

* ``chained`` (streams): two windowed aggregates in a row, per slide and then per block
  of two window lengths, one starting every window length.  State holds a row per slide
  for the watermark's length and the counts of emitted slides in two blocks each, not in
  20 windows; a block that is closed is summed into the windows that start in its first
  half, so these come up to a window length later than ``direct`` emits them.  An edit that
  comes when its slide is closed is late as a whole; ``direct`` still counts it in those of
  its windows that are open.

A hot title cannot pin one task in either plan: the final grouping key
includes the window, so a title's rows spread over all of its windows, and
both plans combine map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Params, duration_us
from tidewatch.functions.columns import window_bounds, window_starts_containing


def trending(events: DataFrame, params: Params = DEFAULTS, method: str | None = None,
             time_col: str = "event_time") -> DataFrame:
    """trending_articles rows: window_start, window_end, article_title, server_name, edit_count."""
    method = method or ("direct" if events.isStreaming else "prebucketed")
    if method == "chained":
        return _chained(events, params, time_col)
    if method == "prebucketed" and events.isStreaming:
        raise ValueError("a stream counts its windows directly")
    if method == "direct":
        counted = events.groupBy(
            F.window(time_col, params.trending_window, params.trending_slide).alias("window"),
            F.col("title"),
            F.col("server_name"),
        ).agg(F.count(F.lit(1)).alias("edit_count"))
        return counted.select(
            *window_bounds("window"),
            F.col("title").alias("article_title"),
            F.col("server_name"),
            F.col("edit_count"),
        )
    if method != "prebucketed":
        raise ValueError(f"unknown method {method!r}")
    return _prebucketed(events, params, time_col)


def _chained(events: DataFrame, params: Params, time_col: str) -> DataFrame:
    if duration_us(params.trending_window) % duration_us(params.trending_slide):
        raise ValueError("windows must consist of whole slides")
    size, slide = duration_us(params.trending_window), duration_us(params.trending_slide)
    per_slide = events.groupBy(F.window(time_col, params.trending_slide).alias("slide"), "title", "server_name").agg(
        F.count(F.lit(1)).alias("n"))
    # all windows that start in the first half of a block of two window lengths lie in it
    block = F.window(F.window_time("slide"), f"{2 * size} microseconds", f"{size} microseconds")
    slides = F.collect_list(F.struct(F.unix_micros("slide.start").alias("s"), "n"))
    blocks = per_slide.groupBy(block.alias("block"), "title", "server_name").agg(slides.alias("slides"))
    ws = F.unix_micros("block.start") + F.col("k") * F.lit(slide)
    counted = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(size // slide - 1))).alias("k")).select(
        ws.alias("ws"), "title", "server_name",
        F.aggregate("slides", F.lit(0).cast("long"),
                    lambda total, x: total + F.when((x["s"] >= ws) & (x["s"] < ws + F.lit(size)), x["n"]).otherwise(0)).alias("edit_count"))
    return counted.where("edit_count > 0").select(
        F.timestamp_micros("ws").alias("window_start"), F.timestamp_micros(F.col("ws") + F.lit(size)).alias("window_end"),
        F.col("title").alias("article_title"), "server_name", "edit_count")


def _prebucketed(events: DataFrame, params: Params, time_col: str) -> DataFrame:
    dur = duration_us(params.trending_window)
    slide = duration_us(params.trending_slide)
    if dur % slide:
        # windows are not unions of slide buckets: fall back to the direct plan
        return trending(events, params, "direct", time_col)
    n = dur // slide
    t = F.unix_micros(F.col(time_col))
    bucket = (F.floor(t / F.lit(slide)) * F.lit(slide)).cast("long")
    per_bucket = (
        events.where(F.col(time_col).isNotNull())
        .groupBy(bucket.alias("b"), F.col("title"), F.col("server_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    expanded = per_bucket.select(
        F.explode(window_starts_containing(F.col("b"), slide, n)).alias("ws"),
        "title", "server_name", "n",
    )
    summed = expanded.groupBy("ws", "title", "server_name").agg(F.sum("n").alias("edit_count"))
    return summed.select(
        F.timestamp_micros("ws").alias("window_start"),
        F.timestamp_micros(F.col("ws") + F.lit(dur)).alias("window_end"),
        F.col("title").alias("article_title"),
        F.col("server_name"),
        F.col("edit_count").cast("long").alias("edit_count"),
    )
