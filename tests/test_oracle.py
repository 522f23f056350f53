"""Every registered query against its independent DuckDB formulation.

Runs at sf0.001 by default (the driver runs the same comparison at sf0.01);
set KPILOOM_ORACLE_SF to another test-data folder to widen it.
"""

import os

import pytest

import __spark_entry__ as entry
from kpiloom.plans.registry import QUERIES
from oracle.duckdb_sql import oracle_sql
from oracle_check import compare, connect

SF = os.environ.get("KPILOOM_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert sorted(oracle_sql()) == sorted(NAMES)
    assert set(NAMES) <= set(entry.queries())
    assert len(NAMES) == 75


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, n_spark, n_oracle = compare(spark, con, name, QUERIES[name],
                                          oracle_sql()[name], SF)
    assert not problems, problems
    assert n_spark == n_oracle


def test_failing_checks_have_failures(spark):
    for name in NAMES:
        if name.startswith("dq_failing"):
            assert QUERIES[name](spark, SF).count() > 0, name
    report = QUERIES["dq_suite"](spark, SF).filter("failures > 0")
    assert {r.check_name for r in report.collect()} >= {"not_null", "relationships"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 22 and df.count() > 0
