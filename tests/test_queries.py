"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.run import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name])
    assert not problem


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() == 10
