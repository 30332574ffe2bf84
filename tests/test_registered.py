"""Every registered query with SQL gives exactly the oracle's rows."""

import pytest

from salesprism.plans.catalogue import all_queries
from oracle import compare

QUERIES = all_queries()


@pytest.mark.parametrize("key", [k for k, q in QUERIES.items() if q.oracle])
def test_matches_oracle(key, spark, folder, duck):
    query = QUERIES[key]
    assert compare(query(spark, folder), duck, query.sql()) > 0
