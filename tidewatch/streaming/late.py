"""Late rows as a table of their own.

A stateful operator drops rows silently once they are behind the watermark.  This sink
keeps them: it follows the same rule -- an operator judges micro-batch n by the newest
time of the batches before n - 1, less the allowed delay -- and writes what that drops,
per micro-batch.  What a batch knows of the newest time is written next to the rows
under the batch's number, so a replayed batch finds what it found before.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Params, duration_us
from tidewatch.streaming.sinks import ROWS_PER_FILE, apply_trigger


def late_rows_writer(path: str, params: Params = DEFAULTS, time_col: str = "event_time"):
    """``foreachBatch`` callback: ``<path>/late/batch_id=<n>`` holds the late rows of batch n,
    ``<path>/seen/batch_id=<n>`` one row with the newest time up to it."""
    delay = F.make_dt_interval(secs=F.lit(duration_us(params.watermark_delay)).cast("decimal(18,0)") / F.lit(1_000_000))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = batch.agg(F.max(time_col).alias("newest"))
            if batch_id > 0:
                newest = newest.unionByName(spark.read.schema("newest timestamp").parquet(f"{path}/seen/batch_id={batch_id - 1}"))
            newest.agg(F.max("newest").alias("newest")).coalesce(1).write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")
            if batch_id > 1:
                seen = spark.read.schema("newest timestamp").parquet(f"{path}/seen/batch_id={batch_id - 2}")
                late = batch.where(F.col(time_col) <= seen.select(F.max("newest")).scalar() - delay)
                late.coalesce(max(1, -(-late.count() // ROWS_PER_FILE))).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_late(events: DataFrame, path: str, checkpoint: str, params: Params = DEFAULTS, trigger: dict | None = None,
               query_name: str = "late_rows"):
    """Keep what the jobs on the same stream drop; ``events`` carries no watermark."""
    w = (events.writeStream.foreachBatch(late_rows_writer(path, params))
         .option("checkpointLocation", checkpoint).queryName(query_name))
    return apply_trigger(w, trigger).start()
