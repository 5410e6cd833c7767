"""The queries that SQL can express, against their SQL."""

import pytest

from windrow.llm.oracle import ORACLE
from windrow.llm.queries import QUERIES
from tests.compare import assert_same, oracle_frame


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, name):
    got = QUERIES[name](spark, small).toPandas()
    assert_same(got, oracle_frame(small, ORACLE[name]))
