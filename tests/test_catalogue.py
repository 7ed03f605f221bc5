"""Every query of the contract against its SQL over the same tables."""

import pytest
from compare import connect, differences, expected_of
from conftest import SMALL

import __spark_entry__ as contract
from strikelens.plans import catalogue, oracles


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


# nothing pairs all rows with all rows or leaves the JVM
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(oracles.oracle_sql())
    assert set(catalogue.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, connection, name):
    query = catalogue.QUERIES[name](spark, SMALL)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    actual = query.toArrow()
    expected = expected_of(connection, oracles.oracle_sql()[name])
    assert expected.num_rows > 0
    assert differences(actual, expected) == ""


def test_entry(spark):
    ranked = contract.entry(spark)
    assert ranked.columns == ["index", "year", "species_id", "species_name", "amount"]
    assert ranked.count() > 0


def test_ranking_invariants(spark):
    by_year = {}
    for row in contract.entry(spark).collect():
        by_year.setdefault(row.year, []).append(row)
    assert list(by_year) == sorted(by_year)
    for ranked in by_year.values():
        assert [r["index"] for r in ranked] == list(range(len(ranked)))
        amounts = [r.amount for r in ranked]
        assert amounts == sorted(amounts, reverse=True) and len(ranked) <= 5
