"""Result-table sinks (K1-K3).

* ``append_stream``: a window aggregate in append mode written straight to a
  file table; the file sink's own log makes it exactly-once (K1).
* ``idempotent_batch_writer``: the ``foreachBatch`` callback for update-mode
  queries (K2).  Each micro-batch overwrites its own folder
  ``<table>/run_id=<query id>/batch_id=<n>``, so a batch replayed after a
  failure replaces its earlier output instead of appending it twice, and the
  ``batch_id`` partition column serves time-travel reads (S5).  It holds a
  file per ``rows_per_file`` rows, not one per state partition.  Empty batches write
  nothing (K3); the batch is persisted so the count and the
  write do not run the stateful plan twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ROWS_PER_FILE = 1_000_000


def idempotent_batch_writer(path: str, fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE):
    if fmt not in ("parquet", "orc", "json", "csv"):
        raise ValueError(f"{fmt!r}: a folder per batch needs a plain file format")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.count()  # computes the kept batch at its own width; the write reads it
            if not rows:
                return
            run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"
            (batch.withColumn("committed_at", F.current_timestamp()).coalesce(-(-rows // rows_per_file))
             .write.mode("overwrite").format(fmt)
             .save(f"{path}/run_id={run_id}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return write


def apply_trigger(writer, trigger: dict | None):
    """Default trigger runs the next batch at once; tests pass {'availableNow': True}."""
    return writer.trigger(**trigger) if trigger else writer


def append_stream(df: DataFrame, path: str, checkpoint: str, query_name: str, fmt: str = "parquet",
                  trigger: dict | None = None, date_of: str | None = None):
    """``date_of`` names the time column by whose date (column ``date``) the table is partitioned."""
    if date_of:
        df = df.withColumn("date", F.to_date(date_of))
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).queryName(query_name))
    if date_of:
        w = w.partitionBy("date")
    return apply_trigger(w, trigger).start(path)


def update_stream(df: DataFrame, path: str, checkpoint: str, query_name: str, fmt: str = "parquet",
                  trigger: dict | None = None, writer=None):
    """``writer`` replaces the per-batch folders by another ``foreachBatch`` callback."""
    w = (df.writeStream.outputMode("update").foreachBatch(writer or idempotent_batch_writer(path, fmt))
         .option("checkpointLocation", checkpoint).queryName(query_name))
    return apply_trigger(w, trigger).start()
