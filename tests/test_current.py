"""The table of the latest row per key: equal to the latest of all updates, whatever is replayed."""

import random

import pytest

from test_streams import NOW, STREAM_A, write_batches
from tidewatch.operators import latest_per_key
from tidewatch.sources import from_json_files
from tidewatch.streaming.app import await_all
from tidewatch.streaming.current import _versions, current_table_writer, read_current
from tidewatch.streaming.jobs import start_editors

SCHEMA = "k string, v long"


def test_latest_rows_and_replays(spark, scratch):
    rng = random.Random(1)
    path = f"{scratch}/t"
    with pytest.raises(ValueError):
        read_current(spark, path)
    write = current_table_writer(path, ["k"], ["v"], buckets=4)
    want = {}
    for n in range(6):
        rows = [(rng.choice([f"k{i}" for i in range(30)] + [None]), rng.randrange(100)) for _ in range(rng.choice([0, 3, 40]))]
        batch = spark.createDataFrame(rows, SCHEMA)
        write(batch, n)
        mine = {}
        for k, v in rows:
            mine[k] = max(v, mine.get(k, -1))
        want.update({k: (v, n) for k, v in mine.items()})
        if n % 2:
            write(batch, n)  # replayed after a failure
        if want:
            assert {r.k: (r.v, r.updated_in) for r in read_current(spark, path).collect()} == want
            assert read_current(spark, path).count() == len(want)
    assert max(len(v) for v in _versions(spark, path).values()) <= 2  # older versions are gone


def test_an_unfinished_batch_is_not_read(spark, scratch):
    path = f"{scratch}/t"
    write = current_table_writer(path, ["k"], ["v"], buckets=1)
    write(spark.createDataFrame([("a", 1)], SCHEMA), 0)
    spark.createDataFrame([("a", 9, 1)], SCHEMA + ", updated_in long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch_id=1/bucket=0")
    assert [tuple(r) for r in read_current(spark, path).collect()] == [("a", 1, 0)]
    write(spark.createDataFrame([("a", 2)], SCHEMA), 1)
    assert [tuple(r) for r in read_current(spark, path).collect()] == [("a", 2, 1)]


def test_editors_current_equals_latest_of_the_log(spark, scratch):
    src = from_json_files(spark, write_batches(f"{scratch}/in", STREAM_A), watermark=False)
    await_all([start_editors(src, f"{scratch}/log", f"{scratch}/c1", trigger=NOW, query_name="log"),
               start_editors(src, f"{scratch}/now", f"{scratch}/c2", trigger=NOW, query_name="now", current=4)])
    cols = ["user", "total_edits", "last_activity", "is_expired"]
    log = latest_per_key(spark.read.parquet(f"{scratch}/log"), ["user"], ["batch_id", "span_start", "is_expired", "total_edits"])
    assert sorted(read_current(spark, f"{scratch}/now").select(*cols).collect()) == sorted(log.select(*cols).collect())
