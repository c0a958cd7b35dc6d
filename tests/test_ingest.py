"""P1-P6 on hand-made payloads (FIXTURES section 4) and the ChangeEvent view."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.sources.changes import read_table
from tidewatch.sources import change_events, parse_changes, with_event_time

from data_dirs import SF001


def _parse(spark, lines):
    raw = spark.createDataFrame([(l,) for l in lines], "value string")
    return with_event_time(parse_changes(raw, "value"))


def test_malformed_and_filtered_rows_dropped(spark):
    lines = [
        "garbage",
        '{"id":"x","type":"edit","timestamp":1}',
        '{"id":1.5,"type":"edit","timestamp":1}',
        '{"id":2,"type":"log","timestamp":1}',
        '{"id":7}',
        '{"id":8,"type":"edit"}',
    ]
    assert _parse(spark, lines).count() == 0


def test_numeric_title_and_epoch_seconds(spark):
    rows = _parse(spark, ['{"id":9,"type":"edit","title":3,"timestamp":1709827200,"extra":"ignored"}']).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.title == "3" and r.user is None and r.bot is None
    assert r.event_time.replace(tzinfo=None) == dt.datetime(2024, 3, 7, 16, 0, 0) or \
        r.event_time == dt.datetime(2024, 3, 7, 16, 0, 0)


def test_binary_payload(spark):
    raw = spark.createDataFrame([(bytearray(b'{"id":1,"type":"edit","timestamp":60}'),)], "value binary")
    assert parse_changes(raw, "value").count() == 1


def test_change_view_counts(spark):
    ch = change_events(spark, SF001)
    assert ch.count() == read_table(spark, SF001, "events").count()
    by_type = dict(ch.groupBy("type").count().collect())
    assert set(by_type) == {"edit", "new", "log"}
    assert ch.where(F.col("server_name").isNull()).count() == 0
