"""Registered queries against their SQL; native ones run no Python."""

import pytest

import oracle
from millrace.llm.queries import QUERIES, SQL

NATIVE = ("op1_", "op2_", "op3_", "op7_", "op9_")


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, folder, con, key):
    assert oracle.differences(QUERIES[key](spark, folder), con, SQL[key]) is None


@pytest.mark.parametrize("key", [k for k in sorted(QUERIES) if k.startswith(NATIVE)])
def test_native_plans(spark, folder, key):
    df = QUERIES[key](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert node not in plan


def test_registered(spark):
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
