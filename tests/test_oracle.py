"""Every query against its SQL twin, value for value."""

import pytest

import __spark_entry__ as entry
from windrow.plans.catalog import QUERIES
from windrow.streaming.replayed import REPLAYS
from tests.compare import assert_same, oracle_frame

OWN = {**QUERIES, **REPLAYS}


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, small, name):
    got = entry.queries()[name](spark, small).toPandas()
    assert_same(got, oracle_frame(small, entry.oracle_sql()[name]))


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "store_id", "sum_amount", "tran_count"]
    assert not df.isEmpty()
