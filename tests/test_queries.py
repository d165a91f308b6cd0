import pytest

import __spark_entry__ as contract
from checking import compare
from claimstream.plans.oracles import ORACLES
from claimstream.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    got, expected = compare(spark, FOLDER, QUERIES[name], ORACLES[name])
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
