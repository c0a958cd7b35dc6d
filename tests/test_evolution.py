"""Result tables whose files come from several versions of a job (schema evolution)."""

import pytest

from tidewatch.sources import read_result, register_result
from tidewatch.streaming.sinks import append_stream

OLD = "article_title string, edit_count int"
NEW = "article_title string, server_name string, edit_count bigint"


def _write(spark, path):
    spark.createDataFrame([("A", 1), (None, 2)], OLD).write.parquet(f"{path}/date=2024-01-01")
    spark.createDataFrame([("A", "s", 2**40)], NEW).write.parquet(f"{path}/date=2024-01-02")


def test_read_under_the_later_schema(spark, scratch):
    _write(spark, scratch)
    df = read_result(spark, scratch, schema=NEW)
    assert df.schema["edit_count"].dataType.simpleString() == "bigint" and df.columns[-1] == "date"
    rows = {(r.article_title, r.server_name, r.edit_count, str(r.date)) for r in df.collect()}
    assert rows == {("A", None, 1, "2024-01-01"), (None, None, 2, "2024-01-01"), ("A", "s", 2**40, "2024-01-02")}
    register_result(spark, "evolved", scratch, schema=NEW)
    assert spark.sql("SELECT sum(edit_count) AS n FROM evolved WHERE article_title = 'A'").first().n == 2**40 + 1
    # the older reader still reads the columns it knows, where their types are not narrower
    assert read_result(spark, scratch, schema="article_title string").where("article_title = 'A'").count() == 2


def test_merged_schema_of_all_files(spark, scratch):
    spark.createDataFrame([("A", 1)], "article_title string, edit_count bigint").write.parquet(f"{scratch}/t")
    spark.createDataFrame([("B", "s", 2)], NEW).write.mode("append").parquet(f"{scratch}/t")
    df = read_result(spark, f"{scratch}/t", merge_schema=True)
    assert set(df.columns) == {"article_title", "server_name", "edit_count"}
    assert {(r.article_title, r.server_name, r.edit_count) for r in df.collect()} == {("A", None, 1), ("B", "s", 2)}
    _write(spark, f"{scratch}/mixed")
    with pytest.raises(Exception, match="(?i)merge"):  # types differ: state the schema
        read_result(spark, f"{scratch}/mixed", merge_schema=True).collect()


def test_a_stream_goes_on_with_more_columns(spark, scratch):
    """A later version of an append job continues the table of the earlier one from its checkpoint;
    from a new checkpoint the table's log would take its first batches for ones already written."""
    def run(rows, *columns):
        spark.createDataFrame(rows, NEW).write.mode("append").parquet(f"{scratch}/in")
        feed = spark.readStream.schema(NEW).parquet(f"{scratch}/in").selectExpr(*columns)
        append_stream(feed, f"{scratch}/table", f"{scratch}/ck", "evolving", trigger={"availableNow": True}).awaitTermination()
    run([("A", "s", 1)], "article_title", "int(edit_count) AS edit_count")
    run([("B", "s", 5)], "article_title", "server_name", "edit_count")
    rows = {(r.article_title, r.server_name, r.edit_count) for r in read_result(spark, f"{scratch}/table", schema=NEW).collect()}
    assert rows == {("A", None, 1), ("B", "s", 5)}
