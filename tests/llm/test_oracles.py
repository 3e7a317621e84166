"""The queries with an SQL form against DuckDB, over whole tables at sf0.01."""

import pytest
from compare import compare

from conftest import SF001
from dayflow.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF001), ORACLE[name], SF001)
    assert ok, msg
