"""A table of the latest row per key, kept by a stream (upsert).

Keys are hashed into buckets.  A micro-batch merges its rows with the buckets it touches
and writes these anew under its own number, ``<path>/batch_id=<n>/bucket=<b>``; untouched
buckets stay where they are.  A reader takes the newest version of each bucket of the
batches that were written whole.  A replayed batch merges with what lay there before it
and overwrites its own folder, so it changes nothing.  The version before the newest is
kept for that, older ones are deleted.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.snapshot import latest_per_key

BUCKETS = 64  # a bucket is rewritten by one task: choose them so that one holds some 100 MB


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Per bucket the numbers of the finished batches that wrote it, rising; from folder names."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(context._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    for batch in fs.listStatus(root) if fs.exists(root) else []:
        files = [f.getPath().getName() for f in fs.listStatus(batch.getPath())]
        if "_SUCCESS" in files:
            number = int(batch.getPath().getName().partition("=")[2])
            for name in files:
                if name.startswith("bucket="):
                    out.setdefault(int(name.partition("=")[2]), []).append(number)
    return {b: sorted(v) for b, v in out.items()}


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    p = context._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)


def _read(spark: SparkSession, path: str, newest: dict[int, int], schema) -> DataFrame:
    folders = [f"{path}/batch_id={n}/bucket={b}" for b, n in sorted(newest.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """One row per key, the latest."""
    versions = _versions(spark, path)
    folders = [f"{path}/batch_id={v[-1]}/bucket={b}" for b, v in sorted(versions.items())]
    if not folders:
        raise ValueError(f"{path}: no batch was written yet")
    return spark.read.parquet(*folders)


def current_table_writer(path: str, keys: list[str], order_cols: list[str], buckets: int = BUCKETS):
    """``foreachBatch`` callback: keeps, per key, the row of the newest batch (column
    ``updated_in``) and in it of the greatest ``order_cols``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("updated_in", F.lit(batch_id).cast("long"))
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
            if not touched:
                return
            before = {b: [n for n in v if n < batch_id] for b, v in _versions(spark, path).items() if b in touched}
            old = _read(spark, path, {b: v[-1] for b, v in before.items() if v}, new.schema)
            merged = latest_per_key(old.unionByName(new), keys, ["updated_in", *order_cols]).select(*new.columns)
            (merged.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket")
             .option("partitionOverwriteMode", "static").mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
            for b, v in before.items():
                for n in v[:-1]:
                    _delete(spark, f"{path}/batch_id={n}/bucket={b}")
        finally:
            new.unpersist()

    return write
