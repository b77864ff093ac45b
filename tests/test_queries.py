"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert name in ORACLES
    assert difference(frame, con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
