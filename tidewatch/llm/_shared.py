"""Helpers of the training-data operators: written tables, id columns, seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: Words are maximal runs of anything but ASCII space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts the lineage, so the loss of an executor never repeats finished steps,
    and fixes the rows of steps that are read more than once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path  # for ``dropped``
    return out


def dropped(df: DataFrame) -> None:
    """Delete the folder of a table that ``written`` gave, once a later step is written whole."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def join_each(rows: DataFrame, values: DataFrame, key: str, by: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with ``values``, which has one row per ``key``, where one key may
    hold most of ``rows``.

    The rows of a key are dealt by the hash of ``by`` into as many parts as a shuffle has
    partitions, and its value goes to each part that occurs, so to no more places than
    the key has rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(parts)))
    places = rows.select(key, "_part").distinct()
    return rows.join(values.join(places, key), [key, "_part"], how).drop("_part")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_az(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id falls in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(0)).cast("int")


def word_count(col: Column) -> Column:
    """Number of words of a text (0 for null) without building them as strings."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def boxed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns of ``df`` in one struct, so that working columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unboxed(columns: list[str], name: str = "row") -> list[Column]:
    return [F.col(name)[c].alias(c) for c in columns]
