"""Every named query against its SQL, and the entry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cytoflux.plans import oracles
from cytoflux.plans.queries import REGISTRY
from tests.compare import differences

SF = "/root/testdata/sf0.001"
#: Too few rows at the smallest scale factor to be a test there.
ROWS_ONLY = sorted(set(REGISTRY) - set(oracles.oracle_sql()))


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert not differences(spark, SF, name, REGISTRY[name], oracles.oracle_sql()[name])


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"chrom", "pos", "filter"} <= set(rows[0].asDict())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_samples_are_exact(spark):
    rows = REGISTRY["per_file_sample"](spark, SF).collect()
    assert {s: sum(r.sample_id == s for r in rows) for s in "ANR"} == dict.fromkeys("ANR", 50)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, REGISTRY["per_file_sample"](spark, SF).collect()))
    assert ROWS_ONLY == ["betabin_fit", "mcmc_chains", "per_file_sample", "posterior_clusters", "ward_clusters"]
