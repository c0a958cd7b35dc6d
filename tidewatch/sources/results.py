"""Read side of the result tables.

Tables are Parquet folders; a lakehouse format is used when its package is on
the classpath (``fmt='delta'``).  Tables written by the idempotent sink carry
``batch_id`` / ``committed_at`` columns, which give a time-travel read (S5)
by partition pruning on ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_result(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | StructType | None = None,
                merge_schema: bool = False) -> DataFrame:
    """S3: batch read of a result table, whose files may come from several versions of a job.

    Under a stated ``schema`` a column that a file lacks is null, one that the schema lacks is
    left out, and a narrower number is widened (int to long, float to double); no footer is
    read to plan it.  ``merge_schema`` finds all columns of all files instead: a job over every
    footer, in which a column must have one type throughout.  Columns of the folder names
    (date, run_id, batch_id) are there either way.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def register_result(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Expose a result table to SQL under ``name``; ``options`` as of ``read_result``."""
    df = read_result(spark, path, fmt, **options)
    df.createOrReplaceTempView(name)
    return df


def as_of(df: DataFrame, batch_id=None, committed_at=None, run_id=None) -> DataFrame:
    """Rows of the table as it stood after ``batch_id`` of run ``run_id`` (or at ``committed_at``).

    Batch ids start at 0 again in every run, so a table that names its runs can be
    read by batch only within one of them; ``committed_at`` orders all runs.
    """
    if batch_id is not None and run_id is None and "run_id" in df.columns:
        raise ValueError("batch ids belong to a run: name run_id, or read by committed_at")
    if run_id is not None:
        df = df.filter(F.col("run_id") == F.lit(run_id))
    if batch_id is not None:
        df = df.filter(F.col("batch_id") <= F.lit(batch_id))
    if committed_at is not None:
        df = df.filter(F.col("committed_at") <= F.lit(committed_at).cast("timestamp"))
    return df
