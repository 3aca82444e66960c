"""Every registered query equals its SQL twin, row by row."""

import pytest
from oracle_check import connect, difference
from scales import SMALL

from riskmart.oracles import ORACLES
from riskmart.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    assert difference(spark, duck, SMALL, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
