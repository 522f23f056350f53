"""Data-quality suite: the declared checks pass on clean data, broken frames fail."""

import datetime as dt

from kpiloom.operators import quality, staging
from kpiloom.plans.marts import model_frames
from rows import frame, sources

AS_OF = dt.date(2024, 4, 1)


def test_suite_size_by_kind():
    kinds = [c.kind for c in quality.ALL_CHECKS]
    assert len(kinds) == 68
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 8, "not_null": 35, "accepted_values": 15, "relationships": 3, "between": 7}


def test_suite_finds_the_planted_failures_of_the_driver_tables(spark, sf_small):
    from kpiloom.sources.driver_tables import load_sources
    report = quality.run_checks(model_frames(load_sources(spark, sf_small), as_of=AS_OF),
                                quality.ALL_CHECKS)
    rows = report.collect()
    assert len(rows) == 68
    assert {(r.model, r.column_name, r.check_name) for r in rows if r.failures} == {
        ("stg_leads", "customer_id", "not_null"), ("stg_nps_surveys", "customer_id", "not_null"),
        ("stg_invoices", "customer_id", "not_null"), ("stg_invoices", "customer_id", "relationships")}


def test_broken_frames_are_caught(spark):
    src = sources(
        spark,
        customers=[dict(customer_id="C1"), dict(customer_id="C1", country="FR"),
                   dict(customer_id="C2", monthly_revenue=0, segment=None)],
        subscriptions=[dict(customer_id="C9", churn_reason="bored", churn_date="2023-01-01")],
        invoices=[dict(customer_id="C1", amount=-5, status="lost")],
        partners=[dict(partner_id="P1", commission_rate=1.5)],
        nps_surveys=[dict(customer_id="C1", nps_score=11, csat_score=0)],
    )
    frames = {m: f for m, f in model_frames(src, as_of=AS_OF).items() if m.startswith("stg_")}
    checks = quality.STAGING_CHECKS
    got = {(r.model, r.column_name, r.check_name): r.failures
           for r in quality.run_checks(frames, checks).collect() if r.failures}
    assert got == {
        ("stg_customers", "customer_id", "unique"): 1,
        ("stg_customers", "country", "accepted_values"): 1,
        ("stg_customers", "segment", "not_null"): 1,
        ("stg_customers", "mrr", "between"): 1,
        ("stg_subscriptions", "customer_id", "relationships"): 1,
        ("stg_subscriptions", "churn_reason", "accepted_values"): 1,
        ("stg_invoices", "amount", "between"): 1,
        ("stg_invoices", "status", "accepted_values"): 1,
        ("stg_partners", "commission_rate", "between"): 1,
        ("stg_nps_surveys", "nps_score", "between"): 1,
        ("stg_nps_surveys", "csat_score", "between"): 1,
    }


def test_single_checks_return_failing_rows(spark):
    cust = staging.stg_customers(frame(spark, "customers", [
        dict(customer_id="C1"), dict(customer_id="C1"), dict(customer_id=None),
        dict(customer_id="C3", country="FR"), dict(customer_id="C4", country="FR")]), AS_OF)
    assert [tuple(r) for r in quality.unique(cust, "customer_id").collect()] == [("C1", 2)]
    assert quality.not_null(cust, "customer_id").count() == 1
    bad = quality.accepted_values(cust, "country", quality.COUNTRIES).collect()
    assert [(r.value_field, r.n_records) for r in bad] == [("FR", 2)]
    assert quality.between(cust, "mrr", 0, None, strictly=True).count() == 0
