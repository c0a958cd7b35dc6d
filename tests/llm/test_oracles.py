import pytest
from oracle_check import duck, value_hash

from llm_helpers import SF01
from tidewatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", [k for k in ORACLES if k != "op4_warc"])
def test_query_equals_its_sql(spark, key):
    got, want = QUERIES[key](spark, SF01).toPandas(), duck(SF01).execute(ORACLES[key]).df()
    assert len(got) == len(want)
    assert value_hash(got) == value_hash(want)


def test_warc_equals_its_sql(spark):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    got, want = QUERIES["op4_warc"](spark, SF01).toPandas(), duck(SF01).execute(ORACLES["op4_warc"]).df()
    assert value_hash(got[cols]) == value_hash(want[cols])
    assert (got.refers_to.fillna(-1).astype("int64").sort_values().tolist()
            == want.refers_to.fillna(-1).astype("int64").sort_values().tolist())
