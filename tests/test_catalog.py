"""Every query against its DuckDB counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_every_counterpart_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    line = compare(spark, con, name, SF)
    assert line.startswith(("same", "rows only")), line
