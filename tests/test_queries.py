"""Every registered query against its SQL on the driver's tables."""

import pytest

import __spark_entry__ as contract
from platewatch.plans.oracle import ORACLE
from platewatch.plans.queries import QUERIES
from tests.oracle_check import database, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return database(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    result = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(result, sql.execute(contract.oracle_sql()[name]).df()) is None


def test_flagship(spark):
    assert contract.entry(spark).count() == 435
