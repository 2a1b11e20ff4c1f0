"""Every registered query against its SQL restatement, and the shape of the contract."""
import pytest

import __spark_entry__ as contract
from docquery.plans.check import compare, connect
from docquery.plans.oracles import SQL
from docquery.plans.queries import QUERIES


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    from tests.conftest import DATA

    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, data, name):
    assert compare(spark, con, data, name) == ""


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 40 and "text" in rows.columns
