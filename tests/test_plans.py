"""Physical-plan properties the marts are designed for (guards against regressions)."""

import contextlib
import io

import pytest

from kpiloom.plans.registry import FANOUT_QUERIES, QUERIES

FORBIDDEN = ("SortAggregate", "ObjectHashAggregate", "CartesianProduct",
             "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {name: plan(q(spark, sf_small)) for name, q in QUERIES.items()}


def test_no_slow_operators_anywhere(plans):
    bad = {name: [op for op in FORBIDDEN if op in text] for name, text in plans.items()}
    assert {name: ops for name, ops in bad.items() if ops} == {}


def test_at_risk_chain_shuffles_each_input_once(plans):
    # customers, active subscriptions, surveys, overdue invoices: one exchange each,
    # all on customer_id, and the three joins reuse that partitioning
    text = plans["at_risk_customers"].split("\n\n\n")[0]   # the operator tree
    assert text.count("Exchange") == 4
    assert text.count("SortMergeJoin") == 3


def test_no_jobs_while_plans_are_built(spark, sf_small):
    from kpiloom.plans.marts import build_marts
    from kpiloom.plans.registry import staged
    from kpiloom.sources.driver_tables import load_sources
    sources = load_sources(spark, sf_small)  # reads the files' schemas
    staged(spark, sf_small)
    spark.sparkContext.setJobGroup("plans-only", "")
    try:
        build_marts(sources)
        for name, query in QUERIES.items():
            # these write a table, find hot customers, or read a schema
            runs = ("read_source", "sink_", "present_", "skewed_", "sql_", "dq_failing_accepted_values", *FANOUT_QUERIES)
            if not name.startswith(runs):
                query(spark, sf_small)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_debt_mart_joins_invoices_once(plans):
    text = plans["mart_debt_collection"].split("\n\n\n")[0]
    assert text.count("SortMergeJoin") + text.count("BroadcastHashJoin") == 1
    assert "Expand" in text


def test_scans_are_pruned_and_filtered(plans):
    text = plans["lead_metrics"]
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("props" not in s and "value" not in s for s in schemas)
    assert "EqualTo(event_type" in text or "In(event_type" in text
