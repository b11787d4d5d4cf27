"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from contract.check import difference, oracle
from contract.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_oracle(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0
