"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, con, name):
    frame = contract.queries()[name](spark, SF)
    if name in ORACLES:
        assert differences(frame, con, ORACLES[name]) == []
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 150
