"""Partial counts before a shuffle by key (T7): edits per (key, time) of each task's rows.

A streaming aggregate combines map-side, keyed state in Python does not: every row of
a key would cross the shuffle and reach one task.  ``partial_counts`` is the missing
combiner: each task reduces its Arrow batches to one row per key and event time with
a count, so a key receives at most one row per task and second of the micro-batch,
however many edits it has.  Times are kept exactly, so Spark's late filter still
decides row by row; a watermark is therefore set after this step, not before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

HELD_ROWS = 200_000  # partial rows a task holds before it passes them on


def _combine(key: str, time_col: str):
    def summed(tables: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(tables).group_by([key, time_col]).aggregate([("edits", "sum")])
        return t.select([key, time_col, "edits_sum"]).rename_columns([key, time_col, "edits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                held.append(summed([pa.Table.from_batches([batch])]))
            if sum(t.num_rows for t in held) > HELD_ROWS:
                held = [summed(held)]
                if held[0].num_rows > HELD_ROWS // 2:  # few rows share a key and time
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()
    return run


def partial_counts(events: DataFrame, key: str, time_col: str = "event_time") -> DataFrame:
    """(key, time, edits): counts whose sums per (key, time) are those of ``events``.

    Null keys and times are values like others.  Works on tables and streams.
    """
    kind = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    return events.select(key, time_col, F.lit(1).cast("long").alias("edits")).mapInArrow(
        _combine(key, time_col), f"`{key}` {kind[key]}, `{time_col}` {kind[time_col]}, edits long")


def has_watermark(df: DataFrame, time_col: str = "event_time") -> bool:
    """Whether the stream's time column carries a watermark already."""
    return "spark.watermarkDelayMs" in (df.schema[time_col].metadata or {})
