"""Published read-side queries over the result tables.

Each takes DataFrames (read with ``tidewatch.sources.read_result`` or produced
by the batch operators) and returns a DataFrame; the top-N ones end in
``orderBy(...).limit(n)``, which Spark plans as ``TakeOrderedAndProject``
(per-partition top-N, then a merge of n rows per partition), never a full sort.
Ties are broken on the remaining key columns so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import duration_us
from tidewatch.functions.columns import round2
from tidewatch.operators.snapshot import latest_per_key


def _as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def _cutoff(as_of, lookback: str) -> Column:
    return _as_of_col(as_of) - F.make_dt_interval(secs=F.lit(duration_us(lookback)).cast("decimal(18,0)") / F.lit(1_000_000))


def top_trending(trending: DataFrame, as_of=None, lookback: str = "1 hour", limit: int = 20,
                 mode: str = "window_sum", window: str = "10 minutes") -> DataFrame:
    """Q1: top titles by summed edit counts of windows starting in the last ``lookback``.

    ``mode='window_sum'`` is the published query: overlapping windows are summed,
    so each edit counts up to 20 times.  ``mode='distinct_edits'`` keeps only the
    windows aligned to the window length, which tile time, so each edit counts once.
    """
    df = trending.where(F.col("window_start") >= _cutoff(as_of, lookback))  # P12, on the bare column: pushed down
    if "date" in trending.columns:  # a table partitioned by the date of its windows
        df = df.where(F.col("date") >= F.to_date(_cutoff(as_of, lookback)))
    if mode == "distinct_edits":
        df = df.where(F.unix_micros("window_start") % F.lit(duration_us(window)) == 0)
    elif mode != "window_sum":
        raise ValueError(f"unknown mode {mode!r}")
    agg = df.groupBy("article_title", "server_name").agg(F.sum("edit_count").alias("total_edits"))
    return agg.orderBy(F.desc("total_edits"), "article_title", "server_name").limit(limit)  # O1


def top_trending_from_events(events: DataFrame, as_of=None, lookback: str = "1 hour", limit: int = 20,
                             mode: str = "window_sum", params=None, time_col: str = "event_time") -> DataFrame:
    """Q1 straight from edits, reading only the lookback period.

    A window that starts at or after the cutoff holds only edits at or after the
    cutoff, so filtering the edits first is exact: windows that start earlier
    get partial counts but are removed by the same cutoff in ``top_trending``.
    The 20-way window expansion then touches only the last ``lookback`` of data.
    """
    from tidewatch.config import DEFAULTS
    from tidewatch.operators.trending import trending

    params = params or DEFAULTS
    recent = events.where(F.col(time_col) >= _cutoff(as_of, lookback))
    return top_trending(trending(recent, params, time_col=time_col), as_of=as_of, lookback=lookback, limit=limit,
                        mode=mode, window=params.trending_window)


def active_board(editors: DataFrame, limit: int = 20, latest: bool = True,
                 version_cols: tuple[str, ...] | None = None) -> DataFrame:
    """Q2: most active editors that have not expired.

    The table is an update log, so by default the latest snapshot of each editor
    is taken first (W4) and then filtered; ``latest=False`` is the raw published
    form over every snapshot.
    """
    # batch ids start again in every run; the commit time, where kept, orders all of them
    version = list(version_cols or [c for c in ("committed_at", "batch_id") if c in editors.columns])
    df = latest_per_key(editors, ["user"], version) if latest else editors
    df = df.where(~F.col("is_expired"))  # P11
    return (df.select("user", "total_edits", "last_activity")
            .orderBy(F.desc("total_edits"), "user", F.desc("last_activity")).limit(limit))


def spike_board(spikes: DataFrame, limit: int = 20) -> DataFrame:
    """Q3: most recent spikes with the ratio rounded to 2 places."""
    return (
        spikes.where(F.col("is_spike"))
        .select("article_title", "window_start", "window_end", "current_edit_count",
                "historical_average", round2(F.col("spike_multiplier")).alias("spike_ratio"))
        .orderBy(F.desc("window_start"), "article_title")  # O2
        .limit(limit)
    )


def hourly_heatmap(trending: DataFrame, since=None) -> DataFrame:
    """Q4: summed window counts per hour of window start and server (O3 order), of windows
    starting at ``since`` or later where it is given."""
    if since is not None:
        trending = trending.where(F.col("window_start") >= _as_of_col(since))
        if "date" in trending.columns:
            trending = trending.where(F.col("date") >= F.to_date(_as_of_col(since)))
    hour = F.date_trunc("hour", F.col("window_start"))
    return (trending.groupBy(hour.alias("hour_bucket"), F.col("server_name"))
            .agg(F.sum("edit_count").alias("total_edits"))
            .orderBy(F.desc("hour_bucket"), F.desc("total_edits"), "server_name"))


def hourly_heatmap_from_events(events: DataFrame, params=None, time_col: str = "event_time") -> DataFrame:
    """Q4 straight from edits without expanding each edit into its windows.

    An edit in slide bucket ``b`` lies in the windows starting at
    ``b, b - slide, ..., b - (n-1)*slide``.  When that span is shorter than an
    hour the starts fall into at most two hours: ``min(n, (b - hour(b))/slide + 1)``
    of them in the bucket's own hour and the rest in the hour before.  Edits are
    first counted per (bucket, server) -- combined map-side -- and each bucket
    then contributes at most two weighted rows instead of n window rows.
    Falls back to the expanded plan for other window shapes.
    """
    from tidewatch.config import DEFAULTS
    from tidewatch.operators.trending import trending

    params = params or DEFAULTS
    dur, slide, hour = duration_us(params.trending_window), duration_us(params.trending_slide), 3_600_000_000
    n = dur // slide
    if dur % slide or (n - 1) * slide >= hour or hour % slide:
        return hourly_heatmap(trending(events, params, time_col=time_col))
    t = F.unix_micros(F.col(time_col))
    per_bucket = (events.where(F.col(time_col).isNotNull())
                  .groupBy((F.floor(t / F.lit(slide)) * F.lit(slide)).cast("long").alias("b"), F.col("server_name"))
                  .agg(F.count(F.lit(1)).alias("c")))
    h = (F.floor(F.col("b") / F.lit(hour)) * F.lit(hour)).cast("long")
    here = F.least(F.floor((F.col("b") - h) / F.lit(slide)) + 1, F.lit(n)).cast("long")
    parts = per_bucket.select(
        "server_name",
        F.explode(F.array(
            F.struct(h.alias("h"), (F.col("c") * here).alias("w")),
            F.struct((h - F.lit(hour)).alias("h"), (F.col("c") * (F.lit(n) - here)).alias("w")),
        )).alias("p"),
    ).where(F.col("p.w") > 0)
    return (parts.groupBy(F.timestamp_micros(F.col("p.h")).alias("hour_bucket"), F.col("server_name"))
            .agg(F.sum("p.w").alias("total_edits"))
            .orderBy(F.desc("hour_bucket"), F.desc("total_edits"), "server_name"))


def table_stats(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Q5: data files and bytes per result table, from file metadata.

    One row per file from the listing; no file is opened, and files without rows count too.
    """
    parts = []
    for name, path in tables.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", f"*.{fmt}").load(path).select("path", "length"))
        parts.append(files.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
                     .select(F.lit(name).alias("table_name"), "file_count", "total_bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
