"""ChangeEvent rows derived from the driver's ``events`` table.

The driver tables carry no change feed of their own; this view maps every
``events`` row to one ChangeEvent so the analyses run over the whole table.
It is a pure projection (no shuffle) and keeps the scan to the six columns of
``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schema import CHANGE_COLUMNS

# --- fixed values of the view --------------------------------------------------
# event_type -> change type: view, click, purchase -> edit; signup -> new; error -> log
# server_name: element (event_id % 3) of a.example, b.example, c.example
# title: 'page_' || props.k ; user: 'user_' || user_id
# bot: user_id % 10 = 0 ; minor: value < 10 ; namespace: props.k % 5
# wiki: first letter of server_name ; comment: event_type
# ------------------------------------------------------------------------------
TYPE_MAP = {"view": "edit", "click": "edit", "purchase": "edit", "signup": "new", "error": "log"}
SERVERS = ("a.example", "b.example", "c.example")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def changes_from_events(events: DataFrame) -> DataFrame:
    """ChangeEvent columns plus ``event_time`` (the exact ``ts`` as TIMESTAMP)."""
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    change_type = F.lit(None).cast("string")
    for src, dst in TYPE_MAP.items():
        change_type = F.when(et == src, F.lit(dst)).otherwise(change_type)
    server = F.element_at(F.array(*[F.lit(s) for s in SERVERS]), (F.col("event_id") % 3 + 1).cast("int"))
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("page_"), k.cast("string")).alias("title"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        F.unix_seconds(event_time).alias("timestamp"),
        change_type.alias("type"),
        server.alias("server_name"),
        et.alias("comment"),
        (F.col("user_id") % 10 == 0).alias("bot"),
        (F.col("value") < 10).alias("minor"),
        (k % 5).cast("int").alias("namespace"),
        F.substring(server, 1, 1).alias("wiki"),
        event_time.alias("event_time"),
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_from_events(read_table(spark, sf_dir, "events"))


__all__ = ["read_table", "changes_from_events", "change_events", "CHANGE_COLUMNS", "TYPE_MAP", "SERVERS"]
