"""Schemas of the change event and of the three result tables (section 1.2)."""

from pyspark.sql import types as T

# ChangeEvent: all nullable, epoch seconds in ``timestamp``.
CHANGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("server_name", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("namespace", T.IntegerType()),
    T.StructField("wiki", T.StringType()),
])

CHANGE_COLUMNS = [f.name for f in CHANGE_SCHEMA.fields]

WINDOWED_COUNT_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("edit_count", T.LongType()),
])

TRENDING_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("article_title", T.StringType()),
    T.StructField("server_name", T.StringType()),
    T.StructField("edit_count", T.LongType()),
])

EDITOR_SCHEMA = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("total_edits", T.LongType()),
    T.StructField("last_activity", T.TimestampType()),
    T.StructField("is_expired", T.BooleanType()),
])

SPIKE_SCHEMA = T.StructType([
    T.StructField("article_title", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("current_edit_count", T.LongType()),
    T.StructField("historical_average", T.DoubleType()),
    T.StructField("spike_multiplier", T.DoubleType()),
    T.StructField("is_spike", T.BooleanType()),
])
