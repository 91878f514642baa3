"""Every registered query gives the rows of its SQL on the smallest data set."""

import pytest

import __spark_entry__ as contract
from placeseek.plans import load_all
from placeseek.plans.registry import ORACLES, QUERIES
from tests.oracle import compare, database

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    load_all()
    # Greedy selection is compared with brute force in test_signals.py.
    assert set(QUERIES) - set(ORACLES) == {"g8_varied_hits"}


@pytest.mark.parametrize("name", list(contract.queries()))
def test_same_rows(spark, con, name):
    problem, _, _ = compare(spark, con, FOLDER, name, contract.queries()[name], SQL.get(name))
    assert problem is None, problem


def test_entry(spark):
    assert contract.entry(spark).count() > 0
