"""The operators' queries against their SQL."""

from __future__ import annotations

import pytest

from cytoflux.llm import oracles, queries
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert not differences(spark, "/root/testdata/sf0.001", name, queries.queries()[name], oracles.oracle_sql()[name])
