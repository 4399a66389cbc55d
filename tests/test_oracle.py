"""Every registered query with a SQL twin must equal it on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    problem = oracle.differences(contract.queries()[name](spark, SF), con, SQL[name])
    assert problem is None, problem


def test_every_twin_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry_gives_a_plan(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"cand", "Truck", "Departure Time", "Locations"}
    for row in rows:
        names = row["Locations"].split(" -> ")
        assert len(names) > 2 and names[0] == names[-1]
