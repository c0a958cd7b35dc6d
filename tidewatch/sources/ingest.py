"""Ingest: raw payloads -> parsed, filtered, event-timed, watermarked edits.

S1 (Kafka source), S2 (binary -> string), P1-P6 (parse, flatten, filters,
event time), T1 (watermark), K6 (publish raw payloads).  Everything is a
DataFrame expression, so the same code serves batch and streaming frames and
Catalyst prunes the parsed struct down to the fields a job reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Params
from tidewatch.functions.columns import is_blank
from tidewatch.schema import CHANGE_SCHEMA


def parse_changes(raw: DataFrame, value_col: str = "value", params: Params = DEFAULTS) -> DataFrame:
    """Parse JSON text (or Kafka bytes) with the fixed schema, PERMISSIVE.

    Malformed text yields an all-null struct and is removed by ``id IS NOT NULL``;
    only ``type = 'edit'`` survives (a null type is dropped as well).
    """
    text = F.col(value_col).cast("string")  # S2: binary Kafka value -> string
    # P1+P2 as one generator: ``inline(array(from_json(..)))`` parses each payload
    # once and flattens it.  With ``select(from_json(..).alias("event")).select("event.*")``
    # Catalyst pushes each filter below the projection and re-parses the JSON per
    # filtered field (three extra parses per row); predicates on generated
    # columns stay above the Generate, so here the parse happens exactly once.
    return (
        raw.select(F.inline(F.array(F.from_json(text, CHANGE_SCHEMA))))
        .filter(F.col("id").isNotNull())
        .filter(F.col("type") == params.edit_type)
    )


def with_event_time(df: DataFrame) -> DataFrame:
    """Epoch seconds -> TIMESTAMP, rows without one are dropped."""
    return df.withColumn("event_time", F.col("timestamp").cast("timestamp")).filter(
        F.col("event_time").isNotNull()
    )


def edits(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The P3/P4/P6 filters for frames that already carry ChangeEvent columns."""
    return df.filter(
        F.col("id").isNotNull() & (F.col("type") == params.edit_type) & F.col("event_time").isNotNull()
    )


def watermarked(df: DataFrame, params: Params = DEFAULTS, column: str = "event_time") -> DataFrame:
    """Bound lateness; T2 (late-row drop) is Spark's per-operator filter."""
    return df.withWatermark(column, params.watermark_delay)


def deduplicated(df: DataFrame, key: str = "id") -> DataFrame:
    """Events delivered more than once, within the watermark's delay of each other, come once.

    Keys are kept until the watermark passes them, so state is bounded by the delay."""
    return df.dropDuplicatesWithinWatermark([key])


def kafka_reader_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                         fail_on_data_loss: bool = False, **extra: str) -> dict[str, str]:
    """S1 option set; ``extra`` passes ``kafka.*`` client settings through."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def from_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, params: Params = DEFAULTS,
               **options: str) -> DataFrame:
    """S1 -> watermarked edits. Needs the Kafka connector on the classpath."""
    raw = spark.readStream.format("kafka").options(
        **kafka_reader_options(bootstrap_servers, topic, **options)
    ).load()
    return watermarked(with_event_time(parse_changes(raw, "value", params)), params)


def from_json_files(spark: SparkSession, path: str, params: Params = DEFAULTS,
                    max_files_per_trigger: int = 1, watermark: bool = True) -> DataFrame:
    """In-container twin of S1: newline JSON files, one file per micro-batch."""
    raw = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
    parsed = with_event_time(parse_changes(raw, "value", params))
    return watermarked(parsed, params) if watermark else parsed


def publish_raw(raw: DataFrame, value_col: str = "raw", fmt: str = "kafka",
                path: str | None = None, **options: str):
    """K6: forward raw payloads verbatim (null key), skipping blank ones.

    ``fmt='kafka'`` needs ``kafka.bootstrap.servers`` and ``topic`` options and the
    connector jar; ``fmt='text'`` writes the same lines to ``path``.
    Works for batch and streaming frames: returns the writer for the caller to
    ``save()`` / ``start()``.
    """
    out = raw.where(~is_blank(F.col(value_col))).select(F.col(value_col).cast("string").alias("value"))
    writer = out.writeStream if raw.isStreaming else out.write
    writer = writer.format(fmt).options(**options)
    if path is not None:
        writer = writer.option("path", path)
    return writer


def raw_change_json() -> Column:
    """ChangeEvent columns -> one JSON payload per row (the wire form)."""
    return F.to_json(F.struct(*[F.col(c) for c in CHANGE_SCHEMA.fieldNames()]))
