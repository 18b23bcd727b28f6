"""Every registered query equals its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from pulse.plans.oracle import ORACLE
from pulse.plans.queries import QUERIES
from pulse.plans.verify import compare


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle_sf0001(spark, name):
    r = compare(spark, QUERIES[name], ORACLE[name], SF["0.001"])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "bus_factor_label" in df.columns
