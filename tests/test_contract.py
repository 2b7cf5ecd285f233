"""Every contract query against its oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from wickwork.plans.contract import REGISTRY
from tests.compare import oracle_connection, oracle_result, spark_result, type_mismatches
from tests.helpers import executed

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(contract.queries())
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_oracle(spark, duck, name):
    sql = contract.oracle_sql()[name]
    df = contract.queries()[name](spark, SF_DIR)
    columns, rows = spark_result(df)
    wanted_columns, wanted = oracle_result(duck, sql)
    assert columns == wanted_columns
    assert rows, "a query without rows proves nothing"
    assert rows == wanted
    assert not type_mismatches(df, duck, sql)
    plan = executed(df)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert banned not in plan
    assert plan.split("Initial Plan")[0].count("events.parquet") <= 1


def test_entry(spark):
    assert contract.entry(spark).count() == 5
