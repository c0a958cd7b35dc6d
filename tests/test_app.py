"""Wiring: Kafka options (S1), SQL over result paths (S4), raw publish (K6),
three queries from one stream (T13, T14), relative-time default (P12)."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.config import QUERY_NAMES, TABLE_NAMES
from tidewatch.plans import top_trending
from tidewatch.sources import from_json_files, kafka_reader_options, publish_raw, register_result
from tidewatch.streaming.app import await_all, start_all, table_paths

from test_streams import STREAM_A, write_batches


def test_kafka_reader_options():
    opts = kafka_reader_options("b1:9092,b2:9092", "changes", **{"kafka.security.protocol": "SSL"})
    assert opts == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "changes", "startingOffsets": "latest",
        "failOnDataLoss": "false", "kafka.security.protocol": "SSL",
    }


def test_publish_raw_skips_blank_payloads(spark, scratch):
    raw = spark.createDataFrame([('{"id":1}',), ("   ",), (None,), ('{"id":2}',)], "raw string")
    publish_raw(raw, fmt="text", path=f"{scratch}/out").mode("overwrite").save()
    assert sorted(r.value for r in spark.read.text(f"{scratch}/out").collect()) == ['{"id":1}', '{"id":2}']


def test_sql_over_result_path(spark, scratch):
    spark.createDataFrame([("A", True), ("B", False)], "article_title string, is_spike boolean") \
        .write.parquet(f"{scratch}/edit_spikes")
    register_result(spark, "edit_spikes_view", f"{scratch}/edit_spikes")
    got = spark.sql("SELECT article_title FROM edit_spikes_view WHERE is_spike = true").collect()
    assert [r.article_title for r in got] == ["A"]
    direct = spark.sql(f"SELECT count(*) AS n FROM parquet.`{scratch}/edit_spikes`").collect()[0].n
    assert direct == 2


def test_relative_time_defaults_to_now(spark):
    old = dt.datetime(2024, 1, 1)
    tr = spark.createDataFrame([(old, old, "A", "s", 3)], "window_start timestamp, window_end timestamp, "
                                                            "article_title string, server_name string, edit_count long")
    assert top_trending(tr).count() == 0  # nothing in the last hour of wall clock
    assert top_trending(tr, as_of=F.lit(old)).count() == 1


def test_start_all_runs_three_named_queries(spark, scratch):
    src = from_json_files(spark, write_batches(f"{scratch}/input", STREAM_A))
    queries = start_all(src, scratch, trigger={"availableNow": True}, spike_expiry="event_time",
                        spike_ttl="3650 days")
    assert sorted(q.name for q in queries) == sorted(QUERY_NAMES)
    await_all(queries)
    paths = table_paths(scratch)
    assert set(paths) == set(TABLE_NAMES)
    assert spark.read.parquet(paths["trending_articles"]).count() > 0
    assert spark.read.parquet(paths["active_editors"]).where("is_expired").count() == 2
    assert spark.read.parquet(paths["edit_spikes"]).count() == 5
