import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    # Optional operators may add queries that SQL cannot express.
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert differences(spark, database, name, SF_DIR) == []


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
