"""Replay a change table as a file stream (in-container twin of the Kafka feed).

The changes are serialised to their JSON wire form and written as text files by
one job, a folder per ``period`` of event time with ``files_per_batch`` files.  A
file source takes files in the order of their modification times, so these are then
set by period and name: the order is stated, not left to the writer.  With
``maxFilesPerTrigger = files_per_batch`` each period is a micro-batch.  Only file
names pass through the driver.

Two flush batches with a single event each, a day past the newest event,
close every window and expire every key; their title and user are
``FLUSH`` and must be removed from results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import duration_us
from tidewatch.schema import CHANGE_SCHEMA
from tidewatch.sources.ingest import raw_change_json

FLUSH = "__flush__"
FIRST_TIME = 1_600_000_000  # modification time of the first file, seconds


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_marker(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()[0]


def flush_rows(changes: DataFrame) -> DataFrame:
    """Two edits one day after the newest change, derived from the data."""
    newest = changes.agg(F.max("timestamp").alias("m"))
    rows = newest.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("i"), "m")
    cols = []
    for f in CHANGE_SCHEMA.fields:
        if f.name == "id":
            cols.append((F.lit(-1) - F.col("i")).cast("long").alias("id"))
        elif f.name == "timestamp":
            cols.append((F.col("m") + F.lit(86_400) + F.col("i")).alias("timestamp"))
        elif f.name == "type":
            cols.append(F.lit("edit").alias("type"))
        elif f.name in ("title", "user", "server_name"):
            cols.append(F.lit(FLUSH).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rows.where(F.col("m").isNotNull()).select(*cols)


def write_replay(spark: SparkSession, changes: DataFrame, path: str, period: str = "1 day",
                 flush: bool = True, files_per_batch: int = 1, delay: Column | None = None) -> str:
    """Write ``changes`` (ChangeEvent columns) under ``path``; returns the input folder.

    ``delay`` is the number of periods by which a change arrives after its own."""
    period_s = duration_us(period) // 1_000_000
    wire = changes.select(*CHANGE_SCHEMA.fieldNames())
    batch_no = F.coalesce(F.floor(F.col("timestamp") / F.lit(period_s)) + (F.lit(0) if delay is None else delay), F.lit(-1)).cast("long")
    value = raw_change_json().alias("value")
    rows = wire.select(value, batch_no.alias("batch_no"))
    if flush:
        far = F.lit(1 << 40).cast("long")
        rows = rows.unionByName(flush_rows(wire).select(value, (far + (F.lit(-1) - F.col("id"))).alias("batch_no")))
    target = f"{path}/input"
    part = F.pmod(F.xxhash64("value"), F.lit(files_per_batch))
    rows.repartition("batch_no", part).write.partitionBy("batch_no").text(target)
    _set_times(spark, target)
    return target


def _set_times(spark: SparkSession, target: str) -> None:
    """Modification times one second apart, by period and then by name."""
    fs, root = _fs(spark, target)
    files = []
    for folder in fs.listStatus(root):
        if folder.isDirectory():
            number = int(folder.getPath().getName().partition("=")[2])
            files += [(number, f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder.getPath())]
    for i, (_, _, file) in enumerate(sorted(files, key=lambda x: x[:2])):
        fs.setTimes(file, (FIRST_TIME + i) * 1000, -1)


def replay_input(spark: SparkSession, changes: DataFrame, root: str, period: str = "1 day", **options) -> str:
    """``write_replay`` once per ``root``; later calls reuse the written files.

    Every attempt writes to its own folder and only a finished attempt is
    published through ``LATEST``, so a retry after a failure never appends to a
    half-written input folder.
    """
    done = f"{root}/LATEST"  # no leading underscore: Spark skips such files on read
    if not path_exists(spark, done):
        attempt = f"{root}/attempt-{uuid.uuid4().hex[:12]}"
        target = write_replay(spark, changes, attempt, period, **options)
        write_marker(spark, done, target)
    return read_marker(spark, done)
