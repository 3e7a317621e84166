"""Every registered query against its DuckDB oracle at sf0.01 (whole tables)."""

import pytest

from dayflow.plans.all import ORACLE, QUERIES
from compare import compare

from conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF001), ORACLE[name], SF001)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() > 0
