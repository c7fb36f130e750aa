"""Every registered query against its DuckDB oracle SQL on sf0.001."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import check, duck

SF = "/root/testdata/sf0.001"
# The training-data queries have their own tests in tests/llm.
from goldvein.plans.catalog import QUERIES  # noqa: E402
from goldvein.plans.oracle import ORACLE  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, SF, QUERIES, ORACLE, verbose=True)
    if name in ORACLE:
        assert res["cols_match"] and res["hash_match"], res
    else:
        assert res["rows"] >= 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 24 and df.count() > 0
