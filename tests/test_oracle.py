"""Every batch key of queries() equals its DuckDB oracle on the small driver tables."""

import pytest

import __spark_entry__ as ent
from oracle_check import compare, duck

from data_dirs import SF001
from tidewatch.plans.oracle import ORACLE_SQL
from tidewatch.streaming.registry import STREAM_QUERIES

# the other stream keys are held against each other on small feeds (test_stream_features)
DRAINED = ["as_of_snapshot", "editors_live", "spikes_live", "trending_late", "late_rows", "editors_restart", "spikes_expiring"]
BATCH = [k for k in ORACLE_SQL if k not in STREAM_QUERIES or k in DRAINED]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", BATCH)
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, ent.queries()[key], ent.oracle_sql()[key], SF001, con)
    assert r["cols"] and r["rows"] == r["oracle_rows"] and r["values"], r


def test_every_key_has_a_builder():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["window_start", "window_end", "article_title", "server_name", "edit_count"]
    assert df.count() > 0
